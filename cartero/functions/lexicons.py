"""Word tables of the mail domain.

FIXED VALUES.  Results are defined by these tables, so they are stated as they
are and kept together.  Every table has a fixed size; the longest is the
public English stop list of the vectoriser.
"""

# English abbreviation -> English expansion.
ABBREVIATIONS = {
    "u": "you", "ur": "your", "urs": "yours", "r": "are",
    "pls": "please", "plz": "please", "pl": "please",
    "asap": "as soon as possible", "btw": "by the way",
    "fyi": "for your information", "lol": "laughing out loud",
    "omg": "oh my god", "idk": "i do not know", "tbh": "to be honest",
    "imo": "in my opinion", "imho": "in my humble opinion",
    "fwd": "forward", "fw": "forward", "re": "regarding",
    "msg": "message", "msgs": "messages", "info": "information",
    "adv": "advertisement", "promo": "promotion",
    "dept": "department", "corp": "corporation", "inc": "incorporated",
    "ltd": "limited", "co": "company", "etc": "etcetera",
    "vs": "versus", "eg": "for example", "ie": "that is",
    "dont": "do not", "cant": "cannot", "wont": "will not",
    "im": "i am", "ive": "i have", "youve": "you have",
    "thx": "thanks", "tks": "thanks", "thankx": "thanks",
    "cuz": "because", "coz": "because", "bc": "because",
    "w": "with", "wo": "without", "b4": "before",
    "gr8": "great", "l8r": "later", "2morrow": "tomorrow",
    "2day": "today", "4u": "for you", "4": "for",
    "hrs": "hours", "hr": "hour", "min": "minute",
    "yr": "year", "yrs": "years", "tel": "telephone",
    "no": "number", "nr": "number", "acct": "account",
    "pwd": "password", "usr": "user", "svc": "service",
    "biz": "business",
}

# Misspelling -> correct English.
TYPOS = {
    "recieve": "receive", "adress": "address", "seperate": "separate",
    "occured": "occurred", "guaranteeed": "guaranteed", "unbelivable": "unbelievable",
    "viagara": "viagra", "ciallis": "cialis", "monney": "money",
    "winnner": "winner", "congradulations": "congratulations",
    "oppurtunity": "opportunity", "busines": "business",
}

# English phrase -> Spanish.
PHRASES = {
    "as soon as possible": "lo antes posible",
    "by the way": "por cierto",
    "for your information": "para tu información",
    "in my opinion": "en mi opinión",
    "to be honest": "para ser honesto",
    "free money": "dinero gratis",
    "click here": "haz clic aquí",
    "act now": "actúa ahora",
    "limited time": "tiempo limitado",
    "credit card": "tarjeta de crédito",
    "bank account": "cuenta bancaria",
}

# English word -> Spanish.
GLOSSARY = {
    "free": "gratis", "money": "dinero", "cash": "efectivo", "prize": "premio",
    "winner": "ganador", "win": "ganar", "won": "ganó", "congratulations": "felicitaciones",
    "click": "clic", "offer": "oferta", "bonus": "bono", "discount": "descuento",
    "cheap": "barato", "buy": "comprar", "order": "pedido", "price": "precio",
    "urgent": "urgente", "account": "cuenta", "password": "contraseña",
    "verify": "verificar", "suspended": "suspendida", "limited": "limitado",
    "guaranteed": "garantizado", "opportunity": "oportunidad", "business": "negocio",
    "credit": "crédito", "loan": "préstamo", "debt": "deuda", "bank": "banco",
    "card": "tarjeta", "viagra": "viagra", "cialis": "cialis", "pharmacy": "farmacia",
    "pills": "pastillas", "weight": "peso", "loss": "pérdida",
    "please": "por favor", "thanks": "gracias", "hello": "hola", "hi": "hola",
    "dear": "estimado", "friend": "amigo", "team": "equipo",
    "message": "mensaje", "email": "correo", "mail": "correo",
    "information": "información", "promotion": "promoción",
    "advertisement": "anuncio", "company": "empresa", "service": "servicio",
    "customer": "cliente", "meeting": "reunión", "tomorrow": "mañana",
    "today": "hoy", "time": "tiempo", "day": "día", "week": "semana",
    "month": "mes", "year": "año", "hour": "hora", "minute": "minuto",
    "number": "número", "numero": "número", "telephone": "teléfono",
    "user": "usuario", "department": "departamento",
    "energy": "energía", "power": "energía", "gas": "gas", "electricity": "electricidad",
    "contract": "contrato", "deal": "acuerdo", "trade": "comercio",
    "report": "informe", "attached": "adjunto", "forward": "reenviar",
    "regarding": "respecto a", "conference": "conferencia", "call": "llamada",
    "office": "oficina", "manager": "gerente", "president": "presidente",
    "you": "tú", "your": "tu", "are": "eres", "with": "con",
    "without": "sin", "before": "antes", "great": "genial", "later": "luego",
    "because": "porque",
    "software": "software", "computer": "computadora",
    "do": "haz", "not": "no", "know": "sé", "now": "ahora",
    "here": "aquí", "there": "allí", "this": "esto", "that": "eso",
    "tokenurl": "tokenurl", "tokenemail": "tokenemail",
    "tokendinero": "tokendinero", "tokencurrency": "tokendinero",
    "tokenexclam": "tokenexclam", "tokennumero": "tokennumero",
    "tokennumber": "tokennumero",
}

# Abbreviation -> direct Spanish equivalent.
ABBREVIATIONS_ES = {
    "pls": "por favor", "plz": "por favor", "asap": "lo antes posible",
    "btw": "por cierto", "fyi": "para tu información",
    "msg": "mensaje", "info": "información", "promo": "promoción",
    "acct": "cuenta", "pwd": "contraseña", "tel": "teléfono",
    "hrs": "horas", "u": "tú", "ur": "tu",
}

# English phrase left over in a Spanish text -> Spanish.
RESIDUAL_PHRASES = {
    "original mail message": "mensaje de correo original",
    "original message": "mensaje original",
    "forwarded by": "reenviado por",
    "click here": "haga clic aquí",
    "act now": "actúe ahora",
    "as soon as possible": "lo antes posible",
    "for your information": "para su información",
    "by the way": "por cierto",
    "power trading": "comercio de energía",
    "energy services": "servicios de energía",
    "natural gas": "gas natural",
    "subject to": "sujeto a",
    "thank you": "gracias",
    "free money": "dinero gratis",
    "credit card": "tarjeta de crédito",
    "bank account": "cuenta bancaria",
}

# English word left over in a Spanish text -> Spanish.
RESIDUAL_WORDS = {
    "subject": "asunto", "email": "correo", "emails": "correos",
    "mail": "correo", "mails": "correos", "message": "mensaje",
    "messages": "mensajes", "forward": "reenviar", "forwarded": "reenviado",
    "attached": "adjunto", "attachment": "archivo adjunto", "attn": "atención",
    "location": "ubicación",
    "january": "enero", "february": "febrero", "march": "marzo",
    "april": "abril", "may": "mayo", "june": "junio", "july": "julio",
    "august": "agosto", "september": "septiembre", "october": "octubre",
    "november": "noviembre", "december": "diciembre",
    "monday": "lunes", "tuesday": "martes", "wednesday": "miércoles",
    "thursday": "jueves", "friday": "viernes", "saturday": "sábado",
    "sunday": "domingo",
    "office": "oficina", "offices": "oficinas", "energy": "energía",
    "power": "energía", "company": "empresa", "companies": "empresas",
    "business": "negocio", "businesses": "negocios", "deal": "acuerdo",
    "deals": "acuerdos", "trade": "comercio", "trades": "operaciones",
    "trading": "comercialización", "market": "mercado", "markets": "mercados",
    "price": "precio", "prices": "precios", "report": "informe",
    "reports": "informes", "meeting": "reunión", "meetings": "reuniones",
    "contract": "contrato", "contracts": "contratos", "department": "departamento",
    "manager": "gerente", "agreement": "acuerdo", "agreements": "acuerdos",
    "stock": "acciones", "stocks": "acciones", "customer": "cliente",
    "customers": "clientes", "client": "cliente", "clients": "clientes",
    "service": "servicio", "services": "servicios", "product": "producto",
    "products": "productos", "system": "sistema", "systems": "sistemas",
    "information": "información", "conference": "conferencia",
    "free": "gratis", "click": "clic", "money": "dinero", "cash": "efectivo",
    "prize": "premio", "prizes": "premios", "winner": "ganador", "winners": "ganadores",
    "congratulations": "felicitaciones", "bonus": "bono", "discount": "descuento",
    "account": "cuenta", "accounts": "cuentas", "password": "contraseña",
    "passwords": "contraseñas", "urgent": "urgente", "verify": "verificar",
    "offer": "oferta", "offers": "ofertas", "order": "pedido", "orders": "pedidos",
    "dear": "estimado", "hello": "hola", "hi": "hola", "please": "por favor",
    "thanks": "gracias", "thank": "gracias", "welcome": "bienvenido",
    "today": "hoy", "tomorrow": "mañana", "yesterday": "ayer", "week": "semana",
    "weeks": "semanas", "month": "mes", "months": "meses", "year": "año",
    "years": "años", "hour": "hora", "hours": "horas", "minute": "minuto",
    "minutes": "minutos", "time": "tiempo", "daily": "diario",
    "with": "con", "without": "sin", "for": "para", "from": "de",
    "you": "usted", "your": "su", "yours": "suyo", "we": "nosotros",
    "our": "nuestro", "ours": "nuestro", "they": "ellos", "their": "su",
    "theirs": "suyo", "have": "haber", "has": "ha", "had": "había",
    "can": "puede", "should": "debería", "would": "haría", "could": "podría",
    "phone": "teléfono", "call": "llamada", "number": "número",
    "oniine": "en línea", "online": "en línea", "piease": "por favor",
    "soiutions": "soluciones", "soiution": "solución", "inciuding": "incluyendo",
    "resuits": "resultados", "resuit": "resultado", "resuiting": "resultando",
    "materialiy": "materialmente", "pubiisher": "editor", "circuiation": "circulación",
    "soiicitation": "solicitud", "teiecommunications": "telecomunicaciones",
    "revoiutioning": "revolucionando", "revoiution": "revolución",
    "buiiding": "construyendo", "chalienging": "desafiante",
    "caiils": "cialis", "cilais": "cialis", "spuer": "super", "suepr": "super",
    "vagira": "viagra", "viarga": "viagra", "virgaa": "viagra", "vigara": "viagra",
    "vairga": "viagra", "cilck": "clic", "intreseted": "interesado"
}

# Pieces a translator may split a signal token into: (second half, whole token).
SIGNAL_TOKEN_GLUE = [
    ("url", "tokenurl"),
    ("email", "tokenemail"),
    ("dinero", "tokendinero"),
    ("exclam", "tokenexclam"),
    ("n[uú]mero", "tokennumero"),
]

# Signal tokens, in report order.
SIGNAL_TOKENS = ["tokenurl", "tokendinero", "tokenexclam", "tokenemail", "tokennumero"]

# Spanish stop words.
STOP_WORDS_ES = [
    "de", "la", "el", "en", "y", "a", "los", "del", "se", "las",
    "por", "un", "para", "con", "no", "una", "su", "al", "es",
    "lo", "como", "mas", "pero", "sus", "le", "ya", "o", "este",
    "si", "porque", "esta", "entre", "cuando", "muy", "sin",
    "sobre", "tambien", "me", "hasta", "hay", "donde", "quien",
    "desde", "todo", "nos", "tu", "que", "esto", "eso",
]

# Words that give English away when no language model can decide.
ENGLISH_HINTS = ["the", "and", "is", "for", "you", "deal", "meeting", "please", "click", "money"]

# English stop words of the vectoriser (a public list of 318 words).
STOP_WORDS_EN = """
a about above across after afterwards again against all almost alone along already also although always am among amongst
amoungst amount an and another any anyhow anyone anything anyway anywhere are around as at back be became because become
becomes becoming been before beforehand behind being below beside besides between beyond bill both bottom but by call can
cannot cant co con could couldnt cry de describe detail do done down due during each eg eight either eleven else elsewhere
empty enough etc even ever every everyone everything everywhere except few fifteen fifty fill find fire first five for
former formerly forty found four from front full further get give go had has hasnt have he hence her here hereafter hereby
herein hereupon hers herself him himself his how however hundred i ie if in inc indeed interest into is it its itself keep
last latter latterly least less ltd made many may me meanwhile might mill mine more moreover most mostly move much must my
myself name namely neither never nevertheless next nine no nobody none noone nor not nothing now nowhere of off often on
once one only onto or other others otherwise our ours ourselves out over own part per perhaps please put rather re same see
seem seemed seeming seems serious several she should show side since sincere six sixty so some somehow someone something
sometime sometimes somewhere still such system take ten than that the their them themselves then thence there thereafter
thereby therefore therein thereupon these they thick thin third this those though three through throughout thru thus to
together too top toward towards twelve twenty two un under until up upon us very via was we well were what whatever when
whence whenever where whereafter whereas whereby wherein whereupon wherever whether which while whither who whoever whole
whom whose why will with within without would yet you your yours yourself yourselves
""".split()

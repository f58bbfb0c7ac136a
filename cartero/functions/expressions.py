"""Small column helpers shared by the operators.  All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Row count up to which a side is hinted as broadcast.  Only sides whose size is
# fixed by a parameter (vocabulary size x models) are hinted; all others are
# left to the optimizer, which decides on measured sizes.
BROADCAST_ROWS = 1_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    Binding through a one-element array keeps Catalyst from inlining an
    expensive expression into the lambda that reads it.
    """
    return F.transform(F.array(value), body)[0]


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a generator.

    A filter on a projected column is pushed below the projection and evaluates
    the expression a second time; it is not pushed through a generator.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(packed)))


_LITERALS: dict[tuple, tuple[list[Column], Column]] = {}


def table_literals(table: Mapping[str, str]) -> tuple[list[Column], Column]:
    """(keys, map) of a fixed word table as literals, built once per application."""
    context = SparkContext._active_spark_context
    key = (context and context.applicationId, *table.items())
    if key not in _LITERALS:
        keys = [F.lit(k) for k in table]
        pairs = [c for k, v in zip(keys, table.values()) for c in (k, F.lit(v))]
        _LITERALS[key] = keys, F.create_map(*pairs)
    return _LITERALS[key]


def literals(words: Iterable[str]) -> list[Column]:
    """A fixed word list as literals for ``isin``."""
    return table_literals({w: w for w in words})[0]


def lookup(table: Mapping[str, str], fold_case: bool = False) -> Callable[[Column], Column]:
    """Word -> table value, or the word itself.

    Map lookup compares keys one by one; the hashed membership test in front
    keeps it to the words that are in the table.
    """
    keys, values = table_literals(table)

    def replace(word: Column) -> Column:
        key = F.lower(word) if fold_case else word
        return F.when(key.isin(keys), F.try_element_at(values, key)).otherwise(word)

    return replace


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """Plain substring tests, much cheaper than one regular expression."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in needles])


def text_key(text: Column) -> Column:
    """128-bit key of a text, so that shuffles carry 16 bytes and not the text."""
    return F.unhex(F.md5(text))


def hash_order(ident: Column, seed: int | str = 42) -> Column:
    """Deterministic pseudo-random position in [0, 2**32) of a row id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), ident.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint ``df`` as broadcast when its parameters bound it; else leave it alone."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df


def ratio(num: Column, den: Column) -> Column:
    """num / den, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))

"""Scalar helpers built from Spark built-ins (all JVM-side, codegen friendly).

ANSI mode is on by default in Spark 4, so every conversion here is a
``try_`` form: a bad value gives NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, FloatType, IntegralType

# Java's \s class: space, tab, newline, vertical tab, form feed, carriage return.
WHITESPACE_RE = r"[\t\n\x0B\f\r ]"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c) -> Column:
    """Text of a JSON number (quoted or not, integral or fractional) to int;
    fractions are truncated toward zero, out-of-range and junk give NULL."""
    c = as_col(c)
    # a fraction would make a try_cast to int raise and catch an error for each row
    whole = F.when(c.rlike(rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"), c).try_cast("int")
    return F.coalesce(whole, c.try_cast("double").try_cast("int"))


# What a text must look like at least for its conversion to succeed.
_BLANK = r"[\x00-\x20\x7F]*"
_MAY_BE = (
    (IntegralType, rf"^{_BLANK}[+-]?[0-9.]"),
    ((FloatType, DoubleType), rf"(?i)^{_BLANK}[+-]?([0-9.]|nan|inf)"),
    (DateType, rf"(?s)^{_BLANK}[+-]?[0-9]+(-(0?[1-9]|1[0-2])(-(0?[1-9]|[12][0-9]|3[01])([ T].*)?)?)?{_BLANK}$"),
    (BooleanType, rf"(?i)^{_BLANK}(t|true|y|yes|1|f|false|n|no|0){_BLANK}$"),
)


def typed(c, to: DataType | str) -> Column:
    """``try_cast`` of a text, NULL at once for texts that cannot convert: a
    failed ``try_cast`` raises and catches an error, a thousand times the cost
    of one that succeeds."""
    from pyspark.sql.types import _parse_datatype_string
    c, to = as_col(c), _parse_datatype_string(to) if isinstance(to, str) else to
    shape = next((regex for kind, regex in _MAY_BE if isinstance(to, kind)), None)
    return c.try_cast(to) if shape is None else F.when(c.rlike(shape), c).try_cast(to)


def to_float(c) -> Column:
    return as_col(c).try_cast("float")


def to_double(c) -> Column:
    return as_col(c).try_cast("double")


def primitive_float(c, parent: Column | None = None) -> Column:
    """A primitive float field: absent gives 0.0, but NULL when its parent
    object is itself missing or when it holds something that is no number."""
    c = as_col(c)
    v = F.when(c.isNull(), F.lit(0.0).cast("float")).otherwise(to_float(c))
    return v if parent is None else F.when(parent.isNull(), F.lit(None).cast("float")).otherwise(v)


def clean_ws(c) -> Column:
    """Every whitespace character becomes one space, one for one; NULL stays."""
    return F.regexp_replace(as_col(c), WHITESPACE_RE, " ")


def tab_to_space(c) -> Column:
    return F.translate(as_col(c), "\t", " ")


def map_entries_last_wins(m: Column) -> Column:
    """Entries of a parsed JSON object map with repeated keys resolved (last
    wins). The sort-based pass runs only for maps that repeat a key, found by
    a lambda-free size comparison; other maps pass through."""
    keys = F.map_keys(m)
    entries = F.map_entries(m)
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries) \
        .otherwise(dedup_entries_last_wins(entries))


def dedup_entries_last_wins(entries: Column) -> Column:
    """Keep, for each key of an array of map entries, only its last entry
    (JSON objects with a repeated field name: the last one wins).

    Entries are tagged with their position, sorted by (key, position) and an
    entry is kept when the next one has another key: O(n log n) per row."""
    tagged = F.transform(entries, lambda e, i: F.struct(e["key"].alias("key"), i.alias("pos"),
                                                        e["value"].alias("value")))
    ordered = F.array_sort(tagged)
    kept = F.filter(ordered, lambda e, i: (i + 1 == F.size(ordered))
                    | (F.get(ordered, i + 1)["key"] != e["key"]))
    return F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))

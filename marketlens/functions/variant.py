"""Typed columns from JSON whose values vary in type, one value at a time.

A document is parsed once to a VARIANT. Every value is then converted by itself, so a text "12" for a
number is read, a value that does not convert is null, and neither costs the rest of the document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ELEMENTS = "array<variant>"
OBJECT = "map<string,variant>"


def part(value: Column, name: str) -> Column:
    """A field as it stands: null where it is missing, a VARIANT null where it is given as null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", ELEMENTS)


def is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", OBJECT).isNotNull()


def read(value: Column, kind: T.DataType) -> Column:
    """``value`` as ``kind``; null where it does not convert."""
    if isinstance(kind, T.StructType):
        fields = [read(part(value, f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(is_object(value), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(elements(value), lambda x: read(x, kind.elementType))
    if isinstance(kind, (T.LongType, T.IntegerType)):
        # Through a decimal: 12.0 and "12.0" are whole, 12.7 is not.
        number = F.try_variant_get(value, "$", "decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return F.try_variant_get(value, "$", kind.simpleString())


def given(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


Test = Callable[[Column], Column]


# Spark counts the arguments of a lambda, so each test is a closure of one.
def _in_field(name: str, test: Test) -> Test:
    return lambda v: test(part(v, name))


def _in_elements(test: Test) -> Test:
    return lambda v: F.exists(elements(v), lambda x: test(x))


def _unread(kind: T.DataType, path: str) -> Iterator[tuple[str, Test]]:
    """Paths at and below a value with the test that a value there is given and does not convert."""
    if isinstance(kind, T.StructType):
        if path:
            yield path, lambda v: given(v) & ~is_object(v)
        for f in kind.fields:
            for below, test in _unread(f.dataType, f"{path}.{f.name}".lstrip(".")):
                yield below, _in_field(f.name, test)
    elif isinstance(kind, T.ArrayType):
        yield path, lambda v: given(v) & elements(v).isNull()
        for below, test in _unread(kind.elementType, f"{path}[]"):
            yield below, _in_elements(test)
    else:
        yield path, lambda v: given(v) & read(v, kind).isNull()


def unread(value: Column, kind: T.StructType) -> Column:
    """Paths of the values that are given but do not convert, such as ``authors[].id``."""
    found = [F.when(F.coalesce(test(value), F.lit(False)), F.lit(path)) for path, test in _unread(kind, "")]
    return F.array_compact(F.array(*found))


def missing(value: Column, array: str, names: list[str]) -> Column:
    """Names of the fields that some element of ``array`` lacks; a field given as null is there."""
    tests = [(n, _in_field(array, _in_elements(_in_field(n, F.isnull)))) for n in names]
    return F.array_compact(F.array(*(F.when(F.coalesce(test(value), F.lit(False)), F.lit(n)) for n, test in tests)))

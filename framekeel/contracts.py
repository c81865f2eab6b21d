"""Declared inputs and outputs of transforms, checked on the plan before any job runs."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class ContractError(TypeError):
    """A table that does not have what a transform needs, or a transform that does not give what it declares."""


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "number"
    return kind.typeName()


def _unfit(path: str, found: T.DataType, wanted: T.DataType) -> str | None:
    """What is wrong with a type, by the path of the field; wider and narrower numbers fit, whole ones as numbers too."""
    if isinstance(wanted, T.StructType) and isinstance(found, T.StructType):
        own = {f.name: f.dataType for f in found.fields}
        for field in wanted.fields:
            if field.name not in own:
                return f"{path}{field.name} is missing"
            problem = _unfit(f"{path}{field.name}.", own[field.name], field.dataType)
            if problem:
                return problem
        return None
    if isinstance(wanted, T.ArrayType) and isinstance(found, T.ArrayType):
        return _unfit(f"{path.rstrip('.')}[].", found.elementType, wanted.elementType)
    if isinstance(found, T.NullType):
        return None
    has, needs = _family(found), _family(wanted)
    if has == needs or (has, needs) == ("integer", "number"):
        return None
    return f"{path.rstrip('.')} is {found.simpleString()}, not {wanted.simpleString()}"


def _schema(declared: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(declared) if isinstance(declared, str) else declared


def check(df: DataFrame, declared: str | T.StructType, name: str, side: str = "input") -> None:
    """Raise a :class:`ContractError` that names transform and field unless ``df`` has the declared columns."""
    problem = _unfit("", df.schema, _schema(declared))
    if problem:
        raise ContractError(f"{side} of {name}: {problem}")


def transform(*, needs: str | T.StructType = "", gives: str | T.StructType = "") -> Callable:
    """Declare the columns that a transform of a table, its first argument, needs and gives; others may be there.

    Types are DDL or a schema. The check looks at schemas alone, so a wrong type is known before a job starts.
    """

    def declared(function: Callable) -> Callable:
        @wraps(function)
        def checked(df: DataFrame, *args, **kwargs):
            if needs:
                check(df, needs, function.__name__)
            result = function(df, *args, **kwargs)
            if gives:
                check(result, gives, function.__name__, "output")
            return result

        checked.needs, checked.gives = needs, gives
        return checked

    return declared

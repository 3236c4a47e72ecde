"""Conditions of a fetch. Each one is a Column, so Catalyst pushes what it can to the scan."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbflow.model import Status


def is_visible() -> Column:
    """What every fetch and count adds: populated, and either read from the remote once or made here."""
    return (F.col("status") == int(Status.POPULATED)) & (
        F.col("last_modified").isNotNull() | ~F.col("created_remotely")
    )


def refers_to(ref: str | Column, uid: str | None) -> Column:
    """A to-one equals one object. An object without identity yet matches nothing."""
    if uid is None:
        return F.lit(False)
    return _uid(ref) == F.lit(uid)


def refers_to_any(ref: str | Column, uids: Iterable[str | None]) -> Column:
    """A to-one is among a short list of objects; for many objects use ``operators.fetch.in_objects``."""
    known = [uid for uid in uids if uid is not None]
    return _uid(ref).isin(known) if known else F.lit(False)


def any_of_array(refs: str | Column, uids: Iterable[str | None]) -> Column:
    """Some member of an array of references is among a short list of objects."""
    known = [uid for uid in uids if uid is not None]
    column = F.col(refs) if isinstance(refs, str) else refs
    if not known:
        return F.lit(False)
    return F.coalesce(F.exists(column, lambda r: r["uid"].isin(known)), F.lit(False))


def _uid(ref: str | Column) -> Column:
    return (F.col(ref) if isinstance(ref, str) else ref)["uid"]


def _accents() -> tuple[str, str]:
    """Letters with accents and their plain letters; combining marks follow, without a counterpart."""
    accented, plain = [], []
    for code in range(0xC0, 0x2000):
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and all(unicodedata.combining(mark) for mark in base[1:]):
            accented.append(chr(code))
            plain.append(base[0])
    marks = "".join(map(chr, range(0x300, 0x370)))
    return "".join(accented) + marks, "".join(plain)


ACCENTED, PLAIN = _accents()


def fold(text: Column, options: str) -> Column:
    """Text without what the options ignore: ``c`` case, ``d`` accents."""
    if "d" in options:
        text = F.translate(text, ACCENTED, PLAIN)
    return F.lower(text) if "c" in options else text


def _fold_value(value: object, options: str) -> object:
    if isinstance(value, (list, tuple)):
        return [_fold_value(v, options) for v in value]
    if isinstance(value, Column):
        return fold(value, options)
    return fold(F.lit(value), options) if isinstance(value, str) else value


def _fold_pattern(pattern: object, options: str) -> str:
    if not isinstance(pattern, str):
        raise TypeError("a pattern is a text")
    if "d" in options:
        pattern = "".join(c for c in unicodedata.normalize("NFD", pattern) if not unicodedata.combining(c))
    return pattern


def compare(left: Column, operator: str, right: object, options: str = "") -> Column:
    """One comparison by its operator name, with options ``c`` (ignore case) and ``d`` (ignore accents).

    ``right`` is a value, a Column, a pair for BETWEEN, a list for IN, or a pattern for LIKE (``*`` and
    ``?``) and MATCHES (a regular expression for the whole text).
    """
    name = operator.strip().upper()
    options = options.lower()
    if set(options) - {"c", "d"}:
        raise ValueError(f"unknown options {options!r}")
    if name == "LIKE":
        pattern = _sql_pattern(_fold_pattern(right, options))
        text = fold(left, options.replace("c", ""))
        return text.ilike(pattern) if "c" in options else text.like(pattern)
    if name == "MATCHES":
        flags = "(?iu)" if "c" in options else ""
        return fold(left, options.replace("c", "")).rlike(rf"{flags}^(?:{_fold_pattern(right, options)})$")
    if options:
        left, right = fold(left, options), _fold_value(right, options)
    if name in ("=", "=="):
        return left.isNull() if right is None else left == right
    if name in ("!=", "<>"):
        return left.isNotNull() if right is None else left != right
    if name == "IN":
        return left.isin(list(right))
    if name == "BETWEEN":
        low, high = right
        return left.between(low, high)
    simple = {
        "<": left.__lt__,
        "<=": left.__le__,
        ">": left.__gt__,
        ">=": left.__ge__,
        "CONTAINS": left.contains,
        "BEGINSWITH": left.startswith,
        "ENDSWITH": left.endswith,
    }
    if name in simple:
        return simple[name](right)
    raise ValueError(f"unknown comparison {operator!r}")


def _sql_pattern(pattern: str) -> str:
    """``*`` and ``?`` wildcards as a SQL pattern; SQL's own wildcards are taken literally."""
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("*", "%").replace("?", "_")

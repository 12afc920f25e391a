"""Regulator documents as text columns.

A format is data: a tree of :class:`El` whose leaves are :class:`Val`. The tree is
walked once on the driver and becomes one column expression, so documents are
built inside Spark's generated code, one row at a time, with no Python in tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import CODECS, crc_id, uuid5

# Identifiers are stable per namespace; a deployment that must keep identifiers
# issued earlier passes the namespace they were issued under.
NAMESPACE = str(uuid.uuid5(uuid.NAMESPACE_URL, "urn:ledgertide:documents"))


class Val(NamedTuple):
    """A leaf value. ``kind``: const, field, text (parts; '$name' is a field), count,
    uid, crc, now. An empty value goes to ``other`` (a field), then ``fallback``."""

    kind: str
    args: tuple = ()
    codec: str = "text"
    cut: int | None = None
    table: dict | None = None
    default: str | None = None
    other: str | None = None
    fallback: str | None = None


class El(NamedTuple):
    """An element: children or a value. ``when`` is a list of (test, field, value)
    that must all hold; ``each`` repeats it per item of an array field."""

    name: str
    body: tuple | Val = ()
    attrs: tuple = ()
    when: tuple = ()
    each: str | None = None


class Doc(NamedTuple):
    root: El
    suffix: str | None = None
    when: tuple = ()


def const(v: object) -> Val:
    return Val("const", (str(v),))


def field(name: str, codec: str = "text", **more) -> Val:
    return Val("field", (name,), codec, **more)


def text(*parts: str) -> Val:
    return Val("text", parts)


def uid(*parts: str) -> Val:
    return Val("uid", parts)


Lookup = Callable[[str], Column]


def _test(rec: Lookup, conditions: Iterable[tuple]) -> Column:
    ok = F.lit(True)
    for kind, name, *value in conditions:
        col = rec(name)
        ok = ok & {"equals": lambda: F.coalesce(col == value[0], F.lit(False)),
                   "differs": lambda: F.coalesce(col != value[0], F.lit(True)),
                   "present": col.isNotNull,
                   "unpaid": lambda: F.coalesce(col <= 0, F.lit(True)),
                   "positive": lambda: F.coalesce(col > 0, F.lit(False))}[kind]()
    return ok


def _parts(rec: Lookup, parts: tuple, sep: str) -> Column:
    """Parts in order; an absent field counts as the word None, as in issued ids."""
    cols = [F.coalesce(rec(p[1:]).cast("string"), F.lit("None")) if p.startswith("$") else F.lit(p)
            for p in parts]
    return F.concat_ws(sep, *cols)


def _escape(value: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return value


def value(v: Val, rec: Lookup, now: Column, namespace: str = NAMESPACE) -> Column:
    if v.kind == "const":
        return F.lit(v.args[0])
    if v.kind == "count":
        return F.coalesce(F.size(rec(v.args[0])), F.lit(0)).cast("string")
    if v.kind == "now":
        return CODECS[v.codec](now)
    if v.kind == "uid":
        return uuid5(namespace, _parts(rec, v.args, "|"))
    if v.kind == "crc":
        *parts, modulus = v.args
        return crc_id(_parts(rec, tuple(parts), "|"), modulus).cast("string")
    if v.kind == "text":
        return _escape(_parts(rec, v.args, ""))
    raw = rec(v.args[0])
    if v.other or v.fallback is not None:
        raw = F.coalesce(F.nullif(raw, F.lit("")), rec(v.other) if v.other else F.lit(None),
                         F.lit(v.fallback))
    if v.cut is not None:
        raw = F.substring(raw, 1, v.cut)
    if v.table is not None:
        pairs = F.create_map(*[F.lit(x) for kv in v.table.items() for x in kv])
        raw = F.coalesce(pairs[raw], F.lit(v.default) if v.default is not None else raw)
    shaped = CODECS[v.codec](raw)
    return _escape(shaped) if v.codec in ("text", "fr-canonique") else shaped


def attribute_text(col: Column) -> Column:
    """A value inside double quotes of an attribute."""
    for char, written in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
        col = F.replace(col, F.lit(char), F.lit(written))
    return col


def element(el: El, rec: Lookup, now: Column, namespace: str = NAMESPACE) -> Column:
    """The element's text; empty where it does not apply or has nothing to say."""
    if el.each:
        one = el._replace(each=None)
        known = rec.items.get(el.each, set())
        items = F.transform(rec(el.each), lambda item: element(
            one, lambda n: item[n] if n in known else F.lit(None), now, namespace))
        return F.coalesce(F.array_join(items, ""), F.lit(""))
    head = F.concat(F.lit("<" + el.name), *[
        F.concat(F.lit(f' {k}="'), attribute_text(rec(v[1:]).cast("string")) if v.startswith("$") else F.lit(v), F.lit('"'))
        for k, v in el.attrs]) if any(v.startswith("$") for _, v in el.attrs) else F.lit(
        "<" + el.name + "".join(f' {k}="{v}"' for k, v in el.attrs))
    if isinstance(el.body, Val):
        inner = value(el.body, rec, now, namespace)
    elif el.body:
        inner = F.concat(*[element(child, rec, now, namespace) for child in el.body])
    else:
        return _guard(el, rec, F.concat(head, F.lit("/>")))
    return _guard(el, rec, F.concat(head, F.lit(">"), inner, F.lit(f"</{el.name}>")))


def _guard(el: El, rec: Lookup, built: Column) -> Column:
    built = F.when(_test(rec, el.when), built) if el.when else built
    return F.coalesce(built, F.lit(""))


def field_lookup(df: DataFrame) -> Lookup:
    """Columns by name; a field the record type does not carry is NULL. ``items``
    holds the field names of every array-of-struct column."""
    def lookup(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None)
    lookup.items = {f.name: set(f.dataType.elementType.names) for f in df.schema.fields
                    if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)}
    return lookup


# An open tag right before a close tag is an element with nothing in it.
EMPTY_ELEMENT = r"<([^<>/ ]+)( [^<>]*[^<>/])?></[^<>]+>"


def tidy(payload: Column) -> Column:
    return F.regexp_replace(payload, EMPTY_ELEMENT, "<$1$2/>")


def documents(df: DataFrame, market: str, record_type: str, docs: Iterable[Doc], now: Column,
              namespace: str = NAMESPACE) -> DataFrame:
    """Canonical records to (jurisdiction, record_type, record_key, suffix, payload).
    A record whose format has several documents gives one row for each that applies."""
    rec = field_lookup(df)
    built = []
    for doc in docs:
        one = F.struct(F.lit(doc.suffix).cast("string").alias("suffix"),
                       tidy(element(doc.root, rec, now, namespace)).alias("payload"))
        built.append(F.when(_test(rec, doc.when), one) if doc.when else one)
    return (df.select("record_key", F.explode(F.array(*built)).alias("_d")).filter(F.col("_d").isNotNull())
            .select(F.lit(market).alias("jurisdiction"), F.lit(record_type).alias("record_type"), "record_key", "_d.*"))


def deposit_key(record_key: Column, suffix: Column) -> Column:
    return F.concat_ws("-", record_key, suffix)

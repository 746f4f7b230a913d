"""Walking JSON-LD documents: every value of a document as a row.

The first levels of nesting are opened by chained explodes, which stay in generated code;
whatever is nested deeper is unfolded by one expression, so depth has no limit. Nothing is
shuffled. Documents have ``doc_id``, ``version`` and a VARIANT ``body``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkcat.config import DEFAULT, Catalog
from linkcat.functions.mime import literal_map
from linkcat.functions.urls import IS_URL, strip_slashes
from linkcat.operators import trees

MEDIA_KEYS = ("filePath", "contentUrl", "downloadUrl")
ABSOLUTE = IS_URL + r"|^(?:_|mailto|urn|tag|doi|tel|data):"
FIELDS = ("path", "label", "owner", "prop", "value", "kind", "id", "back")
# Kinds of a found value: an object, a list object, the map of reverse properties or an array still to
# open, an object that has been opened, a list object likewise, one that must not be opened, and a scalar.
OBJECT, LIST, REVERSE, ARRAY, OPENED, LISTED, STOPPED, SCALAR = (
    "object", "list", "reverse", "array", "opened", "listed", "stopped", "scalar")
TO_OPEN = (OBJECT, LIST, REVERSE, ARRAY)
#: Begins the step of an array position in a place, so that places sort as the document is written.
AT = "\u0001"
NIL = "http://www.w3.org/1999/02/22-rdf-syntax-ns#nil"
LEVELS = 6
WALKED = ("is_object", "is_list", "stopped", "back", "label")


def text_at(value: Column, path: str) -> Column:
    """A string inside a variant, else NULL."""
    return F.try_variant_get(value, path, "string")


def as_object(value: Column) -> Column:
    """Entries of a variant object as a map, else NULL."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def as_array(value: Column) -> Column:
    """Elements of a variant array, else NULL."""
    return F.try_variant_get(value, "$", "array<variant>")


def has_any_key(value: Column, keys: tuple[str, ...] = MEDIA_KEYS) -> Column:
    """Whether an object has any of the keys."""
    return F.arrays_overlap(F.map_keys(as_object(value)), F.array(*[F.lit(k) for k in keys]))


def part_list(entries: Column) -> Column:
    """``hasPart`` among the entries of a node as an array, a single part included."""
    one = F.try_element_at(entries, F.lit("hasPart"))
    return F.coalesce(as_array(one), F.when(as_object(one).isNotNull(), F.array(one)))


def has_file_parts(entries: Column) -> Column:
    """Whether any part among the entries of a node names a file."""
    return F.coalesce(F.exists(part_list(entries), lambda p: text_at(p, "$.filePath").isNotNull()), F.lit(False))


def is_media(entries: Column, prop: Column) -> Column:
    """Whether a node with these entries stands for media: by its keys, or an encoding made of file parts."""
    keyed = F.arrays_overlap(F.map_keys(entries), F.array(*[F.lit(k) for k in MEDIA_KEYS]))
    return keyed | ((prop == "encoding") & has_file_parts(entries))


def node_iri(ref: Column, catalog: Catalog = DEFAULT) -> Column:
    """Absolute IRI of an ``@id``: CURIEs expand, relative ids resolve against the base."""
    prefix = F.split_part(ref, F.lit(":"), F.lit(1))
    origin = F.try_element_at(literal_map(catalog.context_prefixes), prefix)
    return (
        F.when(ref.rlike(ABSOLUTE), ref)
        .when(ref.contains(":"), F.coalesce(F.concat(origin, F.substring(ref, F.length(prefix) + 2, F.length(ref))), ref))
        .otherwise(F.concat(F.lit(catalog.base), strip_slashes(ref)))
    )


def own_label(ref: Column) -> Column:
    """An id as it is, but a document's own blank labels kept apart from those made here."""
    return F.when(ref.rlike("^_:[bcu]"), F.concat(F.lit("_:u"), F.substring(ref, F.lit(3), F.length(ref)))).otherwise(ref)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, inside an expression."""
    return F.get(F.transform(F.array(value), body), 0)


@dataclass(frozen=True)
class Scope:
    """How contexts bear on a walk.

    ``enter(terms, context)`` gives the terms inside an object with a context, ``resolve(terms, id)`` an absolute id, and
    ``is_list(terms, prop)`` whether a property's arrays are lists. With ``name(terms, key)`` rows have a ``place``, their path
    with keys named so and positions that sort as they are written.
    """

    enter: Callable[[Column, Column], Column]
    resolve: Callable[[Column, Column], Column]
    is_list: Callable[[Column, Column], Column]
    name: Callable[[Column, Column], Column] | None = None


class _Rules:
    """What a walk does with a value that it has just found."""

    def __init__(self, stop, scope: Scope | None):
        self.stop, self.scope = stop, scope
        self.fields = [*FIELDS, *(["terms"] if scope else []), *(["place"] if scope and scope.name else [])]
        self.more = self.fields[len(FIELDS):]

    def plain(self, value: Column, prop: Column, nested: Column, terms: Column | None) -> Column:
        """A set's array in place of the set, and a list object in place of an array that stands for a list or in one."""
        bare = F.coalesce(F.try_variant_get(value, "$['@set']", "variant"), value)
        wanted = nested
        if self.scope:
            wanted = nested | self.scope.is_list(terms, prop)
        # What is a list object already stays one, and null stays null.
        kept = F.try_variant_get(value, "$['@list']", "variant").isNotNull() | F.is_variant_null(value) | (nested & as_array(value).isNull())
        whole = F.to_variant_object(F.struct(F.coalesce(as_array(bare), F.array(bare)).alias("@list")))
        return F.when(wanted & ~kept, whole).otherwise(bare)

    def inside(self, terms: Column, context: Column) -> Column:
        """The terms that hold inside an object with a context, or with none."""
        return F.when(context.isNotNull(), self.scope.enter(terms, context)).otherwise(terms)

    def kind(self, value: Column, entries: Column, prop: Column) -> Column:
        halt = F.coalesce(self.stop(entries, prop), F.lit(False)) if self.stop else F.lit(False)
        whole = F.when(prop == "@reverse", F.lit(REVERSE)).when(F.map_contains_key(entries, "@list"), F.lit(LIST))
        return (
            F.when(entries.isNotNull(), F.when(halt, F.lit(STOPPED)).otherwise(F.coalesce(whole, F.lit(OBJECT))))
            .when(as_array(value).isNotNull(), F.lit(ARRAY))
            .otherwise(F.lit(SCALAR))
        )

    def own_id(self, entries: Column, terms: Column | None) -> Column:
        """The ``@id`` of an object, absolute where contexts count."""
        own = own_label(F.try_element_at(entries, F.lit("@id")).try_cast("string"))
        if self.scope is None:
            return own
        return F.when(own.isNotNull(), self.scope.resolve(self.inside(terms, F.try_element_at(entries, F.lit("@context"))), own))

    def id(self, kind: Column, entries: Column, label: Column, own: Column) -> Column:
        """Id of a found object: its own, else a blank label made from its path; of a list, its first cell's or nil."""
        items = F.try_element_at(entries, F.lit("@list"))
        empty = F.size(F.coalesce(as_array(items), F.array(items))) == 0
        return F.when(kind.isin(OBJECT, STOPPED), F.coalesce(own, F.concat(F.lit("_:b"), label))).when(
            kind == LIST, F.when(empty, F.lit(NIL)).otherwise(cell_label(label, F.lit(0))))


def cell_label(label: Column, position: Column) -> Column:
    """Label of a list's cell, from the label of the list object."""
    return F.concat(F.lit("_:c"), below(label, F.lit("@list")), F.lit("."), position.cast("string"))


def below(label: Column, step: Column) -> Column:
    """Label of a place from that of the container; dots inside keys are written otherwise, so different places have different labels."""
    return F.concat(label, F.when(label == "", F.lit("")).otherwise(F.lit(".")), F.replace(F.replace(step, F.lit("%"), F.lit("%25")), F.lit("."), F.lit("%2E")))


def _position(pos: Column) -> Column:
    return F.concat(F.lit(AT), F.lpad(pos.cast("string"), 10, "0"))


def walk_values(
    docs: DataFrame, stop: Callable[[Column, Column], Column] | None = None, levels: int = LEVELS,
    scope: Scope | None = None,
) -> DataFrame:
    """Every object and scalar of each document; arrays and sets are opened, ``@context`` is skipped.

    Adds ``path`` (keys and array positions from the root), ``owner`` (id of the enclosing
    object), ``prop``, ``value``, ``is_object``, and for objects ``id``: their ``@id`` or a
    blank label made from the path. ``stop(entries, prop)`` marks objects whose inside is
    not opened (``stopped``); the root is always opened. ``back`` marks what stands below ``@reverse``, ``is_list`` a
    list object, whose id is its first cell's label.

    With a ``scope``, rows carry the ``terms`` that hold where they stand by the contexts around them, and ids are absolute.
    """

    keep = [c for c in docs.columns if c not in ("body", "terms")]
    rules = _Rules(stop, scope)
    none = F.lit(None).cast("string")
    start = F.array().cast("array<string>")
    rows = docs.select(
        *keep, start.alias("path"), F.lit("").alias("label"), none.alias("owner"), none.alias("prop"), F.col("body").alias("value"),
        F.lit(False).alias("back"), *([F.col("terms")] if scope else []), *([start.alias("place")] if "place" in rules.more else []))
    rows = rows.withColumn("_entries", as_object(F.col("value")))
    root = F.when(F.col("_entries").isNotNull(), F.lit(OBJECT)).when(as_array(F.col("value")).isNotNull(), F.lit(ARRAY)).otherwise(F.lit(SCALAR))
    rows = rows.withColumn("kind", root).withColumn("_own", rules.own_id(F.col("_entries"), F.col("terms") if scope else None))
    rows = rows.withColumn("id", rules.id(F.col("kind"), F.col("_entries"), F.col("label"), F.col("_own"))).drop("_entries", "_own")
    opener = _opener(keep, rules)
    for _ in range(levels):
        rows = opener(rows)
    deep = F.col("kind").isin(*TO_OPEN)
    rows = rows.withColumn("_x", F.explode_outer(F.when(deep, _unfold(F.struct(*rules.fields), rules))))
    kind = F.col("_kind")
    return (
        rows.select(*keep, *[F.when(deep, F.col(f"_x.{f}")).otherwise(F.col(f)).alias(
            "_kind" if f == "kind" else f) for f in rules.fields])
        .withColumn("is_object", kind.isin(OPENED, STOPPED))
        .withColumn("is_list", kind == LISTED)
        .withColumn("stopped", kind == STOPPED).drop("_kind")
    )


def _opener(keep: list[str], rules: _Rules) -> Callable[[DataFrame], DataFrame]:
    """A step that opens every container found so far by one level; other rows pass through.

    An object yields a row for itself and one per entry, an array one per element. All levels have the same columns, so
    their expressions are made once.
    """
    turns = (
        F.when(F.col("kind").isin(OBJECT, LIST), F.array(F.lit(False), F.lit(True)))
        .when(F.col("kind").isin(ARRAY, REVERSE), F.array(F.lit(True)))
        .otherwise(F.array(F.lit(False)))
    )
    opened, entry, backwards = F.col("_open"), F.col("key").isNotNull(), F.col("kind") == REVERSE
    terms = around = None
    if rules.scope:
        terms = F.col("terms")
        around = rules.inside(terms, F.when(opened & F.col("kind").isin(OBJECT, LIST), F.try_variant_get("_value", "$['@context']", "variant")))
    there = ~opened | (F.col("pos").isNotNull() & (F.coalesce("key", F.lit("")) != "@context"))
    step = F.coalesce("key", F.col("pos").cast("string"))
    prop = F.coalesce("key", "prop")
    nested = F.coalesce((F.col("kind") == ARRAY) & (prop == "@list"), F.lit(False))
    more = [F.col(c) for c in rules.more if c != "place"]
    if "place" in rules.more:
        named = F.when(entry, rules.scope.name(terms, F.col("key"))).otherwise(_position(F.col("pos")))
        more.append(F.when(opened, F.concat("place", F.array(named))).otherwise(F.col("place")).alias("place"))
    columns = [
        *keep, "_open",
        F.when(opened, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
        F.when(opened, below(F.col("label"), step)).otherwise(F.col("label")).alias("label"),
        F.when(entry & ~backwards, F.col("id")).otherwise(F.col("owner")).alias("owner"),
        prop.alias("prop"),
        F.when(opened, rules.plain(F.col("value"), prop, nested, terms)).otherwise(F.col("_value")).alias("value"),
        F.when(opened & entry, backwards).otherwise(F.col("back")).alias("back"),
        F.when(F.col("kind") == OBJECT, F.lit(OPENED)).when(F.col("kind") == LIST, F.lit(LISTED)).otherwise(F.col("kind")).alias("_was"),
        F.col("id").alias("_id"), *more,
    ]
    entries = F.when(opened, as_object(F.col("value")))
    kind = F.when(opened, rules.kind(F.col("value"), F.col("_entries"), F.col("prop"))).otherwise(F.col("_was"))
    own = rules.own_id(F.col("_entries"), terms)
    id = F.when(opened, rules.id(F.col("kind"), F.col("_entries"), F.col("label"), F.col("_own"))).otherwise(F.col("_id"))

    def open_level(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_open", F.explode(turns)).withColumnRenamed("value", "_value")
        if around is not None:
            rows = rows.withColumn("terms", around)
        inside = F.when(opened, F.col("_value")).outer()
        pairs = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(inside)).filter(there)
        children = pairs.select(*columns).withColumn("_entries", entries).withColumn("kind", kind).withColumn("_own", own)
        return children.withColumn("id", id).drop("_open", "_was", "_own", "_id", "_entries")

    return open_level


def _unfold(start: Column, rules: _Rules) -> Column:
    """All values below a container as an array, however deep it goes."""
    as_struct = lambda *values: F.struct(*[v.alias(f) for f, v in zip(rules.fields, values)])
    is_open = lambda x: x["kind"].isin(*TO_OPEN)
    scoped, placed = rules.scope is not None, "place" in rules.more
    whose = lambda x: x["terms"] if scoped else None
    where = lambda x: x["place"] if placed else None

    def found(x: Column, step: Column, named: Column | None, owner: Column, prop: Column, value: Column, nested: Column, back: Column, terms: Column | None) -> Column:
        more = [*([terms] if scoped else []), *([F.concat(where(x), F.array(named))] if placed else [])]
        label = below(x["label"], step)
        struct = lambda v, e, k: as_struct(
            F.concat(x["path"], F.array(step)), label, owner, prop, v, k, rules.id(k, e, label, rules.own_id(e, terms)), back, *more)
        return let(rules.plain(value, prop, nested, terms), lambda v: let(F.struct(v.alias("v"), as_object(v).alias("e")), lambda b: let(
            rules.kind(b["v"], b["e"], prop), lambda k: struct(b["v"], b["e"], k))))

    def opened(x: Column) -> Column:
        own = F.when(x["kind"] == LIST, F.lit(LISTED)).otherwise(F.lit(OPENED))
        me = as_struct(*[own if f == "kind" else x[f] for f in rules.fields])
        backwards = x["kind"] == REVERSE
        entries = F.filter(F.map_entries(as_object(x["value"])), lambda e: e["key"] != "@context")
        name = lambda terms, key: rules.scope.name(terms, key) if placed else None
        inner = lambda terms: F.transform(entries, lambda e: found(
            x, e["key"], name(terms, e["key"]), F.when(backwards, x["owner"]).otherwise(x["id"]), e["key"], e["value"], F.lit(False), backwards, terms))
        if scoped:
            context = F.when(x["kind"].isin(OBJECT, LIST), F.try_variant_get(x["value"], "$['@context']", "variant"))
            inner_rows = let(rules.inside(x["terms"], context), inner)
        else:
            inner_rows = inner(None)
        items = F.transform(as_array(x["value"]), lambda v, i: found(
            x, i.cast("string"), _position(i) if placed else None, x["owner"], x["prop"], v, x["prop"] == "@list", x["back"], whose(x)))
        return F.when(x["kind"].isin(OBJECT, LIST), F.concat(F.array(me), inner_rows)).when(backwards, inner_rows).otherwise(items)

    def step(s: Column, _: Column) -> Column:
        return F.when(F.size(s["todo"]) == 0, s).otherwise(F.struct(
            F.concat(s["done"], F.filter(s["todo"], lambda x: ~is_open(x))).alias("done"),
            F.flatten(F.transform(F.filter(s["todo"], is_open), opened)).alias("todo"),
        ))

    # Each level opens a bracket, so the number of brackets bounds the rounds; a list made of an array opens one more.
    text = F.to_json(start["value"])
    rounds = 2 * (F.length(text) - F.length(F.translate(text, "{[", ""))) + 2
    first = F.array(start)
    empty = F.filter(first, lambda x: F.lit(False))
    state = F.struct(empty.alias("done"), first.alias("todo"))
    return F.aggregate(F.sequence(F.lit(1), rounds), state, step, lambda s: s["done"])


def zone_of(df: DataFrame) -> str:
    """Time zone in which times are written."""
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def _objects(docs: DataFrame, media: bool, values: bool = True) -> DataFrame:
    """Objects of documents read one by one."""
    keep = [c for c in docs.columns if c != "body"]
    text = T.StringType()
    found = [T.StructField("path", T.ArrayType(text)), T.StructField("owner", text), T.StructField("prop", text),
             *([T.StructField("value", T.VariantType())] if values else []), T.StructField("id", text)]
    bodies = docs.select(*keep, "body")
    return bodies.mapInArrow(trees.object_rows(zone_of(docs), media, values), T.StructType([*docs.select(*keep).schema.fields, *found]))


def walk_nodes(docs: DataFrame, values: bool = True) -> DataFrame:
    """Every object of each document, with its ``value`` unless it is not asked for."""
    return _objects(docs, media=False, values=values)


def media_nodes(docs: DataFrame) -> DataFrame:
    """Nodes that stand for media, with their declared type; nothing inside them is opened.

    A root that is media itself is reported and still opened.
    """
    return _objects(docs, media=True).withColumn("type", node_type(F.col("value")))


def node_type(value: Column) -> Column:
    """First ``@type`` of a node."""
    return F.coalesce(text_at(value, "$['@type'][0]"), text_at(value, "$['@type']"))


def document_ids(docs: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Catalog names used as ids anywhere in each document, without their prefix."""
    nodes = walk_nodes(docs, values=False).withColumn("iri", node_iri(F.col("id"), catalog))
    keep = [c for c in docs.columns if c not in ("body",)]
    return (
        nodes.filter(F.col("iri").startswith(catalog.base))
        .select(*keep, F.substring("iri", F.lit(len(catalog.base) + 1), F.length("iri")).alias("id"))
        .distinct()
    )


def subtree(docs: DataFrame, node_id: str, catalog: Catalog = DEFAULT) -> DataFrame:
    """Nodes with a given id, each with its whole content."""
    wanted = node_iri(F.lit(node_id), catalog)
    return walk_nodes(docs).filter(node_iri(F.col("id"), catalog) == wanted)

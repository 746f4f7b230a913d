"""Documents as statements: expand, flatten, compact, N-Quads and graph patterns.

Statements are rows ``(doc columns, subject, predicate, object, object_kind, datatype,
lang)`` with ``object_kind`` iri, blank, literal or number (one with a fraction). Inline contexts are read from the
document's own row, so turning documents into statements needs no shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linkcat.config import DEFAULT, RDF_TYPE, XSD, Catalog
from linkcat.functions import digest
from linkcat.functions.mime import literal_map
from linkcat.operators import trees
from linkcat.operators.nodes import Scope, as_array, as_object, let, node_iri, text_at, walk_values, zone_of
from linkcat.session import durable

STATEMENT = ("subject", "predicate", "object", "object_kind", "datatype", "lang")
UNSUPPORTED_KEYS = ("@nest", "@included")
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
TERMS = "map<string,struct<iri:string,kind:string,container:string,back:boolean,lang:string>>"
#: What the reading below does not cover, in the JSON text of a document, with its name.
UNSUPPORTED = (
    *((f'"{k}":', f"uses {k}") for k in UNSUPPORTED_KEYS),
    (r'"@container":"@(?:language|index|id|type|graph)"', "indexed container"),
    (r'"[^"@][^"]*":"@(?:id|type|value|list|set|graph|language|reverse|context)"', "keyword under another name"),
)


def definitions(context: Column) -> Column:
    """Term definitions of one context object, by term; a term of a null definition has no IRI."""
    text = lambda v, key: text_at(v, f"$['{key}']")
    return F.transform_values(context, lambda k, v: F.struct(
        F.coalesce(text(v, "@reverse"), text(v, "@id"), v.try_cast("string"), F.when(as_object(v).isNotNull(), k)).alias("iri"),
        text(v, "@type").alias("kind"), text(v, "@container").alias("container"),
        text(v, "@reverse").isNotNull().alias("back"), text(v, "@language").alias("lang")))


def enter_context(named: dict[str, dict]):
    """The terms after a context: an object, a name, a list of both, or null, which forgets all terms.

    ``named`` are the contexts that documents may name, objects by name; they travel inside the plan, so they are meant to be few.
    The catalog's own context and unknown names define no terms of their own.
    """
    known = F.create_map(*[x for name, context in named.items() for x in (F.lit(name), F.parse_json(F.lit(json.dumps(context.get("@context", context)))))]) if named else None

    def add(terms: Column, context: Column) -> Column:
        found = as_object(context)
        if known is not None:
            found = F.coalesce(found, as_object(F.try_element_at(known, context.try_cast("string"))))
        merged = let(definitions(found), lambda new: F.when(new.isNull(), terms).otherwise(
            F.map_concat(F.map_filter(terms, lambda k, _: ~F.map_contains_key(new, k)), new)))
        return F.when(F.is_variant_null(context), F.create_map().cast(TERMS)).otherwise(merged)

    return lambda terms, context: F.aggregate(F.coalesce(as_array(context), F.array(context)), terms, add)


def _term(terms: Column, name: Column | str, part: str) -> Column:
    return F.try_element_at(terms, F.lit(name) if isinstance(name, str) else name)[part]


def expand_term(terms: Column, name: Column, catalog: Catalog = DEFAULT) -> Column:
    """IRI of a term or CURIE under the terms in scope and the catalog's own context."""
    name = F.coalesce(_term(terms, name, "iri"), name)
    prefix = F.split_part(name, F.lit(":"), F.lit(1))
    origin = F.coalesce(_term(terms, prefix, "iri"), F.try_element_at(literal_map(catalog.context_prefixes), prefix))
    local = F.substring(name, F.length(prefix) + 2, F.length(name))
    return (
        F.when(~name.contains(":"), F.concat(F.coalesce(_term(terms, "@vocab", "iri"), F.lit(catalog.vocab)), name))
        .when(local.startswith("//") | origin.isNull() | (prefix == "_"), name)
        .otherwise(F.concat(origin, local))
    )


def resolve_id(terms: Column, ref: Column, catalog: Catalog = DEFAULT) -> Column:
    """Absolute form of an id under the terms in scope."""
    prefix = F.split_part(ref, F.lit(":"), F.lit(1))
    own = F.when(~ref.startswith("_:"), _term(terms, prefix, "iri"))
    base = _term(terms, "@base", "iri")
    local = F.substring(ref, F.length(prefix) + 2, F.length(ref))
    return F.when(own.isNotNull() & ref.contains(":") & ~local.startswith("//"), F.concat(own, local)).when(
        base.isNotNull() & ~ref.contains(":"), F.concat(base, ref)).otherwise(node_iri(ref, catalog))


def in_scope(catalog: Catalog = DEFAULT, named: dict[str, dict] | None = None, **more) -> Scope:
    """How a walk reads contexts."""
    return Scope(
        enter_context(named or {}), lambda terms, ref: resolve_id(terms, ref, catalog),
        lambda terms, prop: F.coalesce(_term(terms, prop, "container") == "@list", F.lit(False)), **more)


def _lacks_context() -> Column:
    return F.try_variant_get("body", "$['@context']", "variant").isNull()


def _unsupported_reason() -> Column:
    """Feature of a body that is outside the supported subset, else NULL."""
    text = F.to_json("body")
    return F.coalesce(*[F.when(text.rlike(pattern), F.lit(reason)) for pattern, reason in UNSUPPORTED])


def scoped_docs(docs: DataFrame) -> DataFrame:
    """Documents ready for a walk in scope; the body of one that uses unsupported features is left out."""
    text = F.to_json("body")
    # What patterns have in common is looked for first, as that takes a fraction of their time.
    maybe = reduce(lambda a, b: a | b, [text.contains(x) for x in ('":"@', *(f'"{k}":' for k in UNSUPPORTED_KEYS))])
    outside = maybe & text.rlike("|".join(pattern for pattern, _ in UNSUPPORTED))
    return docs.withColumn("body", F.when(~outside, F.col("body"))).withColumn("terms", F.create_map().cast(TERMS))


def unsupported(docs: DataFrame) -> DataFrame:
    """Documents that use JSON-LD features outside the supported subset, with a reason."""
    return docs.withColumn("reason", _unsupported_reason()).filter("reason is not null")


def split_supported(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that the operators below read in full, and the others as rejects with a reason.

    Both sides are row-wise tests of the body, so nothing is shuffled.
    """
    keep = [c for c in docs.columns if c != "body"]
    reason = F.coalesce(F.when(_lacks_context(), F.lit("no context")), _unsupported_reason())
    judged = docs.withColumn("reason", reason)
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null").select(*keep, "reason")


def expand_name(name: Column, catalog: Catalog = DEFAULT) -> Column:
    """IRI of a term or CURIE under the catalog's own context."""
    prefix = F.split_part(name, F.lit(":"), F.lit(1))
    origin = F.try_element_at(literal_map(catalog.context_prefixes), prefix)
    local = F.substring(name, F.length(prefix) + 2, F.length(name))
    return (
        F.when(~name.contains(":"), F.concat(F.lit(catalog.vocab), name))
        .when(local.startswith("//") | origin.isNull(), name)
        .otherwise(F.concat(origin, local))
    )


def double_lexical(value: Column) -> Column:
    """Canonical xsd:double with the 16 significant digits of the exact binary value.

    Between 1 and 2^53 the fraction is taken apart exactly; outside, the shortest digits that
    name the number are used.
    """
    size = F.abs(value)
    fraction = ((size - F.floor(size)) * F.lit(float(1 << 52))).cast("bigint").cast("decimal(20,0)") / F.lit(
        1 << 52).cast("decimal(20,0)")
    exact = F.floor(size).cast("decimal(18,0)") + fraction.cast("decimal(20,18)")
    tens = F.length(F.floor(size).cast("bigint").cast("string")) - 1
    scale = F.rpad(F.lit("1"), 16 - tens, F.lit("0")).cast("decimal(17,0)")
    digits = F.floor(exact * scale + F.lit(0.5).cast("decimal(2,1)")).cast("string")
    inside = (size >= 1) & (size < float(1 << 53))
    shortest = F.format_string("%.15E", size)
    plain = F.when(
        inside, F.concat(F.substring(digits, 1, 1), F.lit("."), F.substring(digits, 2, 20))
    ).otherwise(F.split_part(shortest, F.lit("E"), F.lit(1)))
    exponent = F.when(inside, tens + F.length(digits) - 16).otherwise(
        F.split_part(shortest, F.lit("E"), F.lit(2)).try_cast("int"))
    mantissa = F.regexp_replace(plain, r"(\.\d+?)0*$", "$1")
    return F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), mantissa, F.lit("E"), exponent.cast("string"))


def expand(docs: DataFrame, catalog: Catalog = DEFAULT, named: dict[str, dict] | None = None) -> DataFrame:
    """Statements of each document, one per occurrence, with absolute IRIs.

    Contexts hold inside the object that has them; ``named`` are those that documents give by name. A list is its cells, each
    with a first item and the rest. Documents that use unsupported features give none instead of wrong ones; ``split_supported`` names them.
    """
    return _statement_rows(docs, catalog, named)


def _statement_rows(docs: DataFrame, catalog: Catalog, named: dict[str, dict] | None = None, labels: bool = False, once: bool = False) -> DataFrame:
    """Statements of documents read one by one, as a set with canonical ``labels`` if asked, or each ``once`` for a key."""
    keep = [c for c in docs.columns if c not in ("body", "terms")]
    bodies = scoped_docs(docs).select(*keep, "body", *([F.to_json("body").alias("_text")] if labels else []))
    kind = T.StructType([*bodies.select(*keep).schema.fields, *(T.StructField(c, T.StringType()) for c in STATEMENT), T.StructField("_number", T.DoubleType())])
    rows = bodies.mapInArrow(trees.statement_rows(catalog, named, zone_of(docs), labels, once), kind)
    # A double's text is made here, as casts make it.
    return rows.withColumn("object", F.coalesce("object", F.col("_number").cast("string"))).drop("_number")


def is_value_object(entries: Column, _: Column) -> Column:
    """Whether an object stands for a literal."""
    return F.map_contains_key(entries, "@value")


def statements(docs: DataFrame, catalog: Catalog = DEFAULT, named: dict[str, dict] | None = None) -> DataFrame:
    """Statements of each document as a set."""
    keep = [c for c in docs.columns if c not in ("body", "terms")]
    if not keep:
        return expand(docs, catalog, named).distinct()
    # Counting the documents of a key brings them together; where they are so already, nothing is moved.
    together = docs.withColumn("_n", F.count("*").over(Window.partitionBy(*keep)))
    return _statement_rows(together, catalog, named, once=True).drop("_n")


def compact_iri(iri: Column, catalog: Catalog = DEFAULT, vocab: bool = True) -> Column:
    """Shortest name of an IRI: a vocabulary term, else a CURIE of the longest prefix, else itself."""
    names = {origin: prefix + ":" for prefix, origin in catalog.context_prefixes.items()}
    if vocab:
        names[catalog.vocab] = ""
    longest_first = sorted(names, key=len, reverse=True)
    pattern = "^(" + "|".join(re.escape(o) for o in longest_first) + ")"
    origin = F.regexp_extract(iri, pattern, 1)
    named = F.concat(F.try_element_at(literal_map(names), origin), F.substring(iri, F.length(origin) + 1, F.length(iri)))
    short = F.coalesce(named, iri)
    return F.when(iri == RDF_TYPE, F.lit("@type")).otherwise(short) if vocab else short


def compact(rows: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Statements with terms and CURIEs in place of IRIs."""
    is_type = F.col("predicate") == RDF_TYPE
    return (
        rows.withColumn(
            "object",
            F.when((F.col("object_kind") == "iri") & is_type, compact_iri(F.col("object"), catalog))
            .when(F.col("object_kind") == "iri", compact_iri(F.col("object"), catalog, vocab=False))
            .otherwise(F.col("object")))
        .withColumn("subject", compact_iri(F.col("subject"), catalog, vocab=False))
        .withColumn("datatype", compact_iri(F.col("datatype"), catalog, vocab=False))
        .withColumn("predicate", compact_iri(F.col("predicate"), catalog))
    )


def flatten(docs: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Nodes merged by id: compacted statements, each once per document and node."""
    return compact(statements(docs, catalog), catalog)


def escape_literal(text: Column) -> Column:
    """Literal text with N-Quads escapes."""
    for char, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def escape_iri(iri: Column) -> Column:
    """IRI with the characters that N-Quads forbids between angle brackets as code points."""
    odd = iri.rlike(r'[\x00-\x20<>"{}|^`\\]')
    coded = F.array_join(F.transform(F.split(iri, ""), lambda c: F.when(
        c.rlike(r'[\x00-\x20<>"{}|^`\\]'), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c)), 4, "0"))).otherwise(c)), "")
    return F.when(odd, coded).otherwise(iri)


def nquad_line() -> Column:
    """N-Quads line of a statement."""
    # Labels with characters that a line does not allow are written in hexadecimal, as are those that look so.
    odd = lambda c: F.concat(F.lit("_:h"), F.hex(F.substring(c, F.lit(3), F.length(c)).cast("binary")))
    name = lambda c: F.when(c.rlike(r"^_:(?!h)\w+([\w.]*\w)?$"), c).when(c.startswith("_:"), odd(c)).otherwise(
        F.concat(F.lit("<"), escape_iri(c), F.lit(">")))
    tail = (
        F.when(F.col("lang").isNotNull(), F.concat(F.lit("@"), "lang"))
        .when(F.col("datatype").isNotNull(), F.concat(F.lit("^^<"), "datatype", F.lit(">")))
        .otherwise(F.lit(""))
    )
    lexical = F.when(F.col("object_kind") == "number", double_lexical(F.col("object").try_cast("double"))).otherwise(
        escape_literal(F.col("object")))
    literal = F.concat(F.lit('"'), lexical, F.lit('"'), tail)
    obj = F.when(F.col("object_kind").isin("literal", "number"), literal).otherwise(name(F.col("object")))
    return F.concat_ws(" ", name(F.col("subject")), name(F.col("predicate")), obj, F.lit("."))


def to_quads(docs: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """N-Quads lines of each document, blank nodes under canonical labels, as a set.

    A document whose key no other has is labelled by itself. Labels of others depend on statements of several rows; these
    are stored, as they are needed for the labels and again for the lines.
    """
    keep = [c for c in docs.columns if c != "body"]
    alone, others = split_repeated(docs, keep)
    lines = _statement_rows(alone, catalog, labels=True).select(*keep, nquad_line().alias("line"))
    if others is None:
        return lines
    labelled = label_blank_nodes(durable(statements(others, catalog)), keep)
    return lines.unionByName(labelled.select(*keep, nquad_line().alias("line")))


def split_repeated(docs: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Documents whose key no other has, and the others, if there are any. Null keys match null keys."""
    count = docs.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    repeated = durable(count.select(*[F.col(k).alias(f"_k_{k}") for k in keys]))
    if repeated.isEmpty():
        return docs, None
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    return docs.join(repeated, same, "left_anti"), docs.join(repeated, same, "left_semi")


def order_graph(quads: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Lines in canonical order within each document."""
    # Sorting samples its input first; lines are stored, so that documents are read once.
    return durable(quads).orderBy(*keys, "line")


def label_blank_nodes(rows: DataFrame, doc_keys: Sequence[str]) -> DataFrame:
    """Canonical blank labels from what each blank node states and is stated about.

    Every blank node gets the order-free digest of its statements, itself read as ``_:a`` and
    other blank nodes as ``_:z``; digests are ranked within the document, ties by first label.
    A document was one row, which bounds its label map.
    """
    masked = lambda c, me: F.when(c == me, F.lit("_:a")).when(c.startswith("_:"), F.lit("_:z")).otherwise(c)
    object_text = F.when(F.col("object_kind") == "blank", masked(F.col("object"), F.col("_me"))).otherwise(
        F.concat_ws("^", "object_kind", "object", F.coalesce("datatype", F.lit("")), F.coalesce("lang", F.lit(""))))
    mentions = F.array_distinct(F.array_compact(F.array(
        F.when(F.col("subject").startswith("_:"), F.col("subject")),
        F.when(F.col("object_kind") == "blank", F.col("object")))))
    hashed = (
        rows.withColumn("_me", F.explode(mentions))
        .groupBy(*doc_keys, "_me")
        .agg(digest.set_digest(F.concat_ws(" ", masked(F.col("subject"), F.col("_me")), "predicate", object_text))
             .alias("_hash"))
    )
    ranked = F.transform(
        F.array_sort(F.collect_list(F.struct("_hash", "_me"))),
        lambda x, i: F.struct(x["_me"], F.concat(F.lit("_:c14n"), i.cast("string"))))
    labels = hashed.groupBy(*doc_keys).agg(F.map_from_entries(ranked).alias("_labels"))
    relabelled = lambda c: F.coalesce(F.try_element_at("_labels", c), c)
    return (
        rows.join(labels, list(doc_keys), "left")
        .withColumn("subject", relabelled(F.col("subject")))
        .withColumn("object", F.when(F.col("object_kind") == "blank", relabelled(F.col("object"))).otherwise(F.col("object")))
        .drop("_labels")
    )


def render_nodes(rows: DataFrame, doc_keys: Sequence[str], expanded: bool) -> DataFrame:
    """One JSON object per node from a statement set; a node never exceeds its document's row."""
    ref = F.to_json(F.struct(F.col("object").alias("@id")))
    native = F.col("datatype").isin(XSD + "integer", XSD + "boolean", "xsd:integer", "xsd:boolean") | (
        F.col("object_kind") == "number")
    quoted = F.regexp_extract(F.to_json(F.array("object")), r"(?s)^\[(.*)\]$", 1)
    bare = F.when(native, F.col("object")).otherwise(quoted)
    typed = F.to_json(F.struct(
        F.col("object").alias("@value"), F.col("datatype").alias("@type"), F.col("lang").alias("@language")))
    plain = native | (F.col("lang").isNull() & F.col("datatype").isNull())
    is_type = F.col("predicate").isin(RDF_TYPE, "@type")
    if expanded:
        whole = F.when(native, F.concat(F.lit('{"@value":'), bare, F.lit("}"))).otherwise(typed)
    else:
        whole = F.when(plain, bare).otherwise(typed)
    text = F.when(is_type, bare).when(F.col("object_kind").isin("literal", "number"), whole).otherwise(ref)
    values = rows.withColumn("_v", text).withColumn(
        "_p", F.when(is_type, F.lit("@type")).otherwise(F.col("predicate")))
    grouped = values.groupBy(*doc_keys, "subject", "_p").agg(F.array_sort(F.collect_list("_v")).alias("_vs"))
    joined = F.array_join("_vs", ",")
    wrapped = F.concat(F.lit("["), joined, F.lit("]"))
    if not expanded:
        wrapped = F.when(F.size("_vs") == 1, joined).otherwise(wrapped)
    text_of = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    entry = F.concat(text_of(F.col("_p")), F.lit(":"), wrapped)
    return (
        grouped.groupBy(*doc_keys, F.col("subject").alias("id"))
        .agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("_body"))
        .select(*doc_keys, "id", F.concat(
            F.lit('{"@id":'), text_of(F.col("id")), F.lit(","), "_body", F.lit("}")).alias("node"))
    )


def as_profile(docs: DataFrame, profile: str = "compacted", catalog: Catalog = DEFAULT) -> DataFrame:
    """Documents in one of the JSON-LD forms, one row per node (per line when normalized, per document for ``document``)."""
    keep = [c for c in docs.columns if c != "body"]
    if profile == "document":
        return compact_documents(docs, catalog)
    if profile == "normalized":
        return to_quads(docs, catalog)
    if profile == "expanded":
        return render_nodes(statements(docs, catalog), keep, expanded=True)
    if profile in ("flattened", "compacted"):
        return render_nodes(flatten(docs, catalog), keep, expanded=False)
    raise ValueError(f"unknown profile: {profile}")


def json_string(text: Column) -> Column:
    """A string as JSON, NULL of NULL."""
    quoted = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(quoted, F.lit(2), F.length(quoted) - 2))


def compact_documents(docs: DataFrame, catalog: Catalog = DEFAULT, named: dict[str, dict] | None = None) -> DataFrame:
    """Each document as one JSON text under the catalog's own context: ``document`` in place of the body.

    Names are read by the contexts around them and written anew. Nesting stays as it is written, so a node that stands twice is shown
    twice, and a reference is an ``@id`` however the node it names goes on; arrays keep their order, an array of one is its
    element, and what is null or an empty array is left out. Entries are sorted by name; blank labels that were not
    written are not shown.

    The tree is put together from its values bottom-up, one pass a level, where the rows of its key are; documents of one key become one.
    """
    keep = [c for c in docs.columns if c not in ("body", "terms")]
    bodies = scoped_docs(docs).select(*keep, "body", F.to_json("body").alias("_text"))
    kind = T.StructType([*bodies.select(*keep).schema.fields, T.StructField("document", T.StringType())])
    whose = [F.col(k) for k in keep]
    return bodies.repartition(*whose).sortWithinPartitions(*whose).mapInArrow(trees.compacted_rows(catalog, named, zone_of(docs)), kind)


def without_context(docs: DataFrame) -> DataFrame:
    """Documents that carry no context and so are no JSON-LD: rejects."""
    return docs.filter(_lacks_context()).withColumn("reason", F.lit("no context"))


def match_pattern(
    rows: DataFrame, subject: str | None = None, predicate: str | None = None, object: str | None = None
) -> DataFrame:
    """Statements that match a triple pattern; an omitted position matches anything."""
    wanted = {"subject": subject, "predicate": predicate, "object": object}
    return reduce(lambda df, w: df.filter(F.col(w[0]) == w[1]) if w[1] is not None else df, wanted.items(), rows)


def match_bgp(rows: DataFrame, patterns: Sequence[tuple[str, str, str]], distinct: bool = True) -> DataFrame:
    """Bindings of a basic graph pattern; positions starting with ``?`` are variables.

    Patterns are joined on the variables they share; one that shares none is refused. Only statements that some pattern asks
    for are stored for the joins.
    """
    asked = [reduce(lambda a, b: a & b, [F.col(c) == x for c, x in zip(("subject", "predicate", "object"), p) if not x.startswith("?")], F.lit(True)) for p in patterns]
    rows = durable(rows.filter(reduce(lambda a, b: a | b, asked)).select("subject", "predicate", "object"))
    bound: DataFrame | None = None
    left = list(patterns)
    while left:
        pick = next(
            (p for p in left if bound is None or set(bound.columns) & {x[1:] for x in p if x.startswith("?")}), None)
        if pick is None:
            raise ValueError("a pattern shares no variable with the others")
        left.remove(pick)
        matched = rows
        names: dict[str, str] = {}
        for position, term in zip(("subject", "predicate", "object"), pick):
            if not term.startswith("?"):
                matched = matched.filter(F.col(position) == term)
            elif term[1:] in names:
                matched = matched.filter(F.col(position) == F.col(names[term[1:]]))
            else:
                names[term[1:]] = position
        matched = matched.select(*[F.col(c).alias(v) for v, c in names.items()])
        bound = matched if bound is None else bound.join(matched, [v for v in names if v in bound.columns])
    return bound.distinct() if distinct else bound

"""Queries over documents as nodes and statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkcat.config import CATALOG_PREFIX, DEFAULT
from linkcat.operators import documents, graph, nodes, vocab
from linkcat.plans import views
from linkcat.plans.describe import LANES, TEXT_DIGEST
from linkcat.plans.registry import query

ORDERS = "SELECT *, 'c' || o_custkey || '/o' || o_orderkey AS doc, o_orderkey AS k FROM orders"
OBJECTS = f"""
SELECT doc AS doc_id, '' AS path, NULL AS prop, doc AS id FROM o
UNION ALL SELECT doc, 'distribution', 'distribution', '_:bdistribution' FROM o
UNION ALL SELECT doc, 'hasPart.0', 'hasPart', doc || '/src' FROM o
UNION ALL SELECT doc, 'hasPart.0.programmingLanguage', 'programmingLanguage', '_:bhasPart.0.programmingLanguage' FROM o
UNION ALL SELECT doc, 'hasPart.0.encoding', 'encoding', '_:bhasPart.0.encoding' FROM o
UNION ALL SELECT doc, 'hasPart.0.encoding.hasPart.' || i, 'hasPart', '_:bhasPart.0.encoding.hasPart.' || i
  FROM o, (VALUES (0), (1)) v(i)
UNION ALL SELECT doc, 'hasPart.1', 'hasPart', doc || '/app' FROM o WHERE k % 3 = 0
UNION ALL SELECT doc, 'about', 'about', doc || '/customer' FROM o
UNION ALL SELECT doc, 'author', 'author', doc || '/customer' FROM o"""
B = "https://catalog.example/"
S = "http://schema.org/"
LEXICAL = (
    r"regexp_replace(split_part(printf('%.15e', object::DOUBLE), 'e', 1), '(\.[0-9]+?)0*$', '\1') || 'E' || "
    "CAST(split_part(printf('%.15e', object::DOUBLE), 'e', 2) AS INTEGER)")
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"


def _rows() -> str:
    """SQL of every statement occurrence of the order documents."""
    root, src, app, cust = (f"'{B}' || doc{x}" for x in ("", " || '/src'", " || '/app'", " || '/customer'"))
    enc, lang = "'_:bhasPart.0.encoding'", "'_:bhasPart.0.programmingLanguage'"
    p0, p1 = "'_:bhasPart.0.encoding.hasPart.0'", "'_:bhasPart.0.encoding.hasPart.1'"
    lit = lambda s, p, o, t="NULL", where="true": (s, f"'{S}{p}'", o, "'literal'", t, where)
    ref = lambda s, p, o, kind="iri", where="true": (s, f"'{S}{p}'", o, f"'{kind}'", "NULL", where)
    typ = lambda s, cls, where="true": (s, f"'{TYPE}'", f"'{S}{cls}'", "'iri'", "NULL", where)
    xsd = "'http://www.w3.org/2001/XMLSchema#"
    third = "k % 3 = 0"
    rows = [
        typ(root, "Dataset"),
        lit(root, "version", "'1.' || (k % 7) || '.' || (k % 5)"), lit(root, "name", "'order ' || k"),
        lit(root, "description", "o_orderpriority"), lit(root, "position", "CAST(k AS VARCHAR)", xsd + "integer'"),
        (root, f"'{S}price'", "CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR)", "'literal'", xsd + "integer'", "o_totalprice = floor(o_totalprice)"),
        (root, f"'{S}price'", "CAST(o_totalprice AS VARCHAR)", "'number'", xsd + "double'", "o_totalprice <> floor(o_totalprice)"),
        lit(root, "isAccessibleForFree", "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END", xsd + "boolean'"),
        ref(root, "license", "'http://creativecommons.org/publicdomain/zero/1.0/'"),
        ref(root, "distribution", "'_:bdistribution'", "blank"),
        lit("'_:bdistribution'", "filePath", "'data/' || k || '.csv'"),
        ref(root, "hasPart", src), typ(src, "Code"), ref(src, "programmingLanguage", lang, "blank"),
        lit(lang, "name", "'c'"), ref(src, "encoding", enc, "blank"),
        ref(enc, "hasPart", p0, "blank"), lit(p0, "filePath", "'src/' || k || '.h'"),
        ref(enc, "hasPart", p1, "blank"), lit(p1, "filePath", "'src/' || k || '.c'"),
        ref(root, "hasPart", app, where=third), typ(app, "SoftwareApplication", third),
        lit(app, "filePath", "'app/' || k || '.zip'", where=third),
        ref(root, "about", cust), ref(root, "author", cust), typ(cust, "Person"),
        lit(cust, "name", "'Customer ' || o_custkey"), lit(cust, "name", "'Customer ' || o_custkey"),
    ]
    return " UNION ALL ".join(
        f"SELECT doc AS doc_id, {s} AS subject, {p} AS predicate, {o} AS object, {kind} AS object_kind, {t} AS datatype "
        f"FROM o WHERE {where}" for s, p, o, kind, t, where in rows)


WITH = f"WITH o AS ({ORDERS}), "
STATEMENTS = WITH + f"st AS ({_rows()}) "
SHORT = f"""
cp AS (SELECT doc_id,
  CASE WHEN starts_with(subject, '{B}') THEN '{CATALOG_PREFIX}:' || substr(subject, {len(B) + 1}) ELSE subject END AS subject,
  CASE WHEN predicate = '{TYPE}' THEN '@type' ELSE substr(predicate, {len(S) + 1}) END AS predicate,
  CASE WHEN object_kind <> 'iri' THEN object WHEN predicate = '{TYPE}' THEN substr(object, {len(S) + 1})
    WHEN starts_with(object, '{B}') THEN '{CATALOG_PREFIX}:' || substr(object, {len(B) + 1}) ELSE object END AS object,
  object_kind, replace(datatype, 'http://www.w3.org/2001/XMLSchema#', 'xsd:') AS datatype FROM st)
"""
SIX = ("doc_id", "subject", "predicate", "object", "object_kind", "datatype")


@query(f"WITH o AS ({ORDERS}) {OBJECTS}")
def walked_nodes(spark, sf):
    """Every object of the order documents."""
    return nodes.walk_nodes(views.order_docs(spark, sf)).select(
        "doc_id", F.array_join("path", ".").alias("path"), "prop", "id")


@query(f"""WITH o AS ({ORDERS})
SELECT doc AS doc_id, 'distribution' AS path, 'DataDownload' AS type FROM o
UNION ALL SELECT doc, 'hasPart.0.encoding', 'MediaObject' FROM o
UNION ALL SELECT doc, 'hasPart.1', 'SoftwareApplication' FROM o WHERE k % 3 = 0""")
def media_nodes(spark, sf):
    """Media nodes of the order documents with their classes."""
    media = nodes.media_nodes(views.order_docs(spark, sf))
    return vocab.infer_type(media, vocab.seed_ranges(spark)).select(
        "doc_id", F.array_join("path", ".").alias("path"), "type")


@query("SELECT doc_id, doc_id % 10 <> 9 AS is_media FROM documents")
def media_keys(spark, sf):
    """Whether link nodes have any media key."""
    return views.link_media(spark, sf).select("doc_id", nodes.has_any_key(F.col("value")).alias("is_media"))


@query(STATEMENTS + "SELECT * FROM st")
def expanded_statements(spark, sf):
    """Statements of the order documents, one per occurrence."""
    return graph.expand(views.order_docs(spark, sf)).select(*SIX)


@query(STATEMENTS + "," + SHORT + "SELECT DISTINCT * FROM cp")
def flattened_statements(spark, sf):
    """Order documents flattened: nodes merged by id, names compacted."""
    return graph.flatten(views.order_docs(spark, sf)).select(*SIX)


@query(f"""WITH o AS ({ORDERS}) SELECT DISTINCT doc_id, id FROM ({OBJECTS}) WHERE NOT starts_with(id, '_:')""")
def document_ids(spark, sf):
    """Catalog ids used inside each order document."""
    return nodes.document_ids(views.order_docs(spark, sf))


@query(STATEMENTS + f"""SELECT DISTINCT doc_id, '<' || subject || '> <' || predicate || '> ' ||
  CASE WHEN object_kind = 'iri' THEN '<' || object || '>' ELSE '"' || CASE WHEN object_kind = 'number' THEN {LEXICAL} ELSE object END || '"' ||
    coalesce('^^<' || datatype || '>', '') END || ' .' AS line
FROM st WHERE NOT starts_with(subject, '_:') AND object_kind <> 'blank'""")
def named_quads(spark, sf):
    """N-Quads lines of the order documents that mention no blank node."""
    return graph.to_quads(views.order_docs(spark, sf)).filter(
        ~F.col("line").startswith("_:") & ~F.col("line").rlike(r" _:c14n\d+ \.$"))


@query(STATEMENTS + """SELECT doc_id, count(DISTINCT (subject, predicate, object)) AS n_lines FROM st GROUP BY 1""")
def quad_counts(spark, sf):
    """Number of N-Quads lines per order document, blank nodes included."""
    return graph.to_quads(views.order_docs(spark, sf)).groupBy("doc_id").agg(F.count("*").alias("n_lines"))


_MASK = "CASE WHEN {0} = me THEN '_:a' WHEN starts_with({0}, '_:') THEN '_:z' ELSE {0} END"


@query(STATEMENTS + f""", d AS (SELECT DISTINCT * FROM st),
me AS (SELECT doc_id, subject AS me, d.* EXCLUDE (doc_id) FROM d WHERE starts_with(subject, '_:')
  UNION ALL SELECT doc_id, object, d.* EXCLUDE (doc_id) FROM d WHERE object_kind = 'blank' AND object <> subject),
hashed AS (SELECT doc_id, me, {TEXT_DIGEST} AS digest FROM (SELECT doc_id, me, count(*) AS n, {LANES} FROM (
  SELECT doc_id, me, sha256({_MASK.format('subject')} || ' ' || predicate || ' ' || CASE WHEN object_kind = 'blank'
    THEN {_MASK.format('object')} ELSE object_kind || '^' || object || '^' || coalesce(datatype, '') || '^' END) AS h FROM me) GROUP BY 1, 2)),
lab AS (SELECT doc_id, me, '_:c14n' || (row_number() OVER (PARTITION BY doc_id ORDER BY digest, me) - 1) AS label FROM hashed)
SELECT d.doc_id, coalesce(a.label, '<' || subject || '>') || ' <' || predicate || '> ' || CASE object_kind WHEN 'blank' THEN b.label
  WHEN 'iri' THEN '<' || object || '>' ELSE '"' || CASE WHEN object_kind = 'number' THEN {LEXICAL} ELSE object END || '"'
  || coalesce('^^<' || datatype || '>', '') END || ' .' AS line
FROM d LEFT JOIN lab a ON a.doc_id = d.doc_id AND a.me = subject
LEFT JOIN lab b ON b.doc_id = d.doc_id AND b.me = object AND object_kind = 'blank'""")
def normalized_documents(spark, sf):
    """Order documents as canonical N-Quads in order."""
    return graph.order_graph(graph.to_quads(views.order_docs(spark, sf)))


@query(f"""WITH o AS ({ORDERS})
SELECT doc AS doc_id, 'ldr:' || doc || '/customer' AS id, '{{"@id":"ldr:' || doc || '/customer","@type":"Person","name":"Customer '
  || o_custkey || '"}}' AS node FROM o
UNION ALL SELECT doc, 'ldr:' || doc || '/app', '{{"@id":"ldr:' || doc || '/app","@type":"SoftwareApplication","filePath":"app/'
  || k || '.zip"}}' FROM o WHERE k % 3 = 0""")
def flattened_nodes(spark, sf):
    """Customers and applications of the order documents as flattened JSON nodes."""
    return graph.as_profile(views.order_docs(spark, sf), "flattened").filter("id like '%/customer' or id like '%/app'")


@query(f"""WITH o AS ({ORDERS})
SELECT doc AS doc_id, '{B}' || doc || '/customer' AS id, '{{"@id":"{B}' || doc || '/customer","@type":["{S}Person"],"{S}name":[{{"@value":"Customer '
  || o_custkey || '"}}]}}' AS node FROM o""")
def expanded_nodes(spark, sf):
    """Customers of the order documents as expanded JSON nodes."""
    return graph.as_profile(views.order_docs(spark, sf), "expanded").filter("id like '%/customer'")


_LIST = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"


def _scoped() -> str:
    """SQL of the statements of orders with contexts of their own."""
    root, kid, cust, clerk, src = (f"'{B}' || doc{x}" for x in ("", " || '/kid'", " || '/customer'", " || '/clerk'", " || '/src'"))
    cells = ("'_:csteps.@list.0'", "'_:csteps.@list.1'")
    rows = [
        (root, S + "step", cells[0], "blank"), (cells[0], _LIST + "first", "'take ' || k", "literal"), (cells[0], _LIST + "rest", cells[1], "blank"),
        (cells[1], _LIST + "first", "'_:bsteps.@list.1'", "blank"), ("'_:bsteps.@list.1'", S + "name", "'send'", "literal"), (cells[1], _LIST + "rest", f"'{_LIST}nil'", "iri"),
        (kid, S + "isPartOf", root, "iri"), (root, S + "keywords", "o_orderpriority", "literal"), (root, S + "keywords", "'status ' || o_orderstatus", "literal"),
        (root, S + "about", cust, "iri"), (cust, "http://xmlns.com/foaf/0.1/nick", "'Customer ' || o_custkey", "literal"),
        (root, S + "author", clerk, "iri"), (clerk, "http://xmlns.com/foaf/0.1/name", "o_orderpriority", "literal"),
        (src, S + "mentions", root, "iri"), (root, S + "notes", f"'{_LIST}nil'", "iri")]
    return " UNION ALL ".join(f"SELECT doc AS doc_id, {s} AS subject, '{p}' AS predicate, {o} AS object, '{kind}' AS object_kind FROM o" for s, p, o, kind in rows)


@query(f"WITH o AS ({ORDERS}) " + _scoped())
def scoped_statements(spark, sf):
    """Statements of orders with nested contexts, lists, sets, reverse properties and a context by name."""
    return graph.expand(views.scoped_docs(spark, sf), named=views.NAMED).select("doc_id", "subject", "predicate", "object", "object_kind")


def _json(text: str) -> str:
    return "'\"' || " + text + " || '\"'"


_SRC = """'{"@id":"ldr:' || doc || '/src","@type":"Code","encoding":{"hasPart":[{"filePath":"src/' || k || '.h"},{"filePath":"src/' || k
  || '.c"}]},"programmingLanguage":{"name":"c"}}'"""
_APP = """'{"@id":"ldr:' || doc || '/app","@type":"SoftwareApplication","filePath":"app/' || k || '.zip"}'"""


@query(f"""WITH o AS ({ORDERS})
SELECT doc AS doc_id, '{{"@context":"{DEFAULT.context}","@id":"ldr:' || doc || '","@type":"Dataset","about":{{"@id":"ldr:' || doc || '/customer","name":"Customer '
  || o_custkey || '"}},"author":{{"@id":"ldr:' || doc || '/customer","@type":"Person","name":"Customer ' || o_custkey || '"}},"description":' || {_json('o_orderpriority')}
  || ',"distribution":{{"filePath":"data/' || k || '.csv"}},"hasPart":' || CASE WHEN k % 3 = 0 THEN '[' || {_SRC} || ',' || {_APP} || ']' ELSE {_SRC} END
  || ',"isAccessibleForFree":' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
  || ',"license":"http://creativecommons.org/publicdomain/zero/1.0/","name":"order ' || k || '","position":' || k || ',"price":' || CAST(o_totalprice AS VARCHAR)
  || ',"version":"1.' || (k % 7) || '.' || (k % 5) || '"}}' AS document FROM o""")
def compacted_documents(spark, sf):
    """Every order document as one compacted JSON text."""
    return graph.as_profile(views.order_docs(spark, sf).select("doc_id", "body"), "document")


@query(f"""WITH o AS ({ORDERS})
SELECT doc AS doc_id, '{{"@context":"{DEFAULT.context}","@id":"ldr:' || doc || '","@reverse":{{"isPartOf":{{"@id":"ldr:' || doc || '/kid"}},"mentions":{{"@id":"ldr:' || doc
  || '/src"}}}},"about":{{"@id":"ldr:' || doc || '/customer","foaf:nick":"Customer ' || o_custkey || '"}},"author":{{"@id":"ldr:' || doc || '/clerk","foaf:name":' || {_json('o_orderpriority')}
  || '}},"keywords":[' || {_json('o_orderpriority')} || ',' || {_json("'status ' || o_orderstatus")} || '],"notes":{{"@list":[]}},"step":{{"@list":["take ' || k || '",{{"name":"send"}}]}}}}' AS document FROM o""")
def compacted_scopes(spark, sf):
    """Orders with contexts of their own, compacted under the catalog's context."""
    return graph.compact_documents(views.scoped_docs(spark, sf), named=views.NAMED)


@query(f"""WITH o AS ({ORDERS}) SELECT doc AS doc_id, 'no context' AS reason FROM o WHERE k % 9 = 4""")
def contextless_documents(spark, sf):
    """Order documents without a context."""
    docs = views.order_docs(spark, sf)
    bare = F.to_variant_object(F.struct(F.col("doc_id").alias("@id")))
    ninth = F.regexp_extract("doc_id", r"o(\d+)$", 1).cast("bigint") % 9 == 4
    return graph.without_context(docs.withColumn("body", F.when(ninth, bare).otherwise(F.col("body")))).select(
        "doc_id", "reason")


@query(STATEMENTS + f"SELECT DISTINCT doc_id, subject FROM st WHERE predicate = '{TYPE}' AND object = '{S}SoftwareApplication'")
def matched_pattern(spark, sf):
    """Statements that type a node as an application."""
    rows = graph.statements(views.order_docs(spark, sf))
    return graph.match_pattern(rows, predicate=TYPE, object=S + "SoftwareApplication").select("doc_id", "subject")


@query(STATEMENTS + f"""
SELECT DISTINCT a.subject AS doc, c.object AS customer FROM st a
JOIN st b ON b.subject = a.subject AND b.predicate = '{S}author'
JOIN st c ON c.subject = b.object AND c.predicate = '{S}name'
JOIN st d ON d.subject = a.subject AND d.predicate = '{S}hasPart'
JOIN st e ON e.subject = d.object AND e.predicate = '{TYPE}' AND e.object = '{S}SoftwareApplication'
WHERE a.predicate = '{S}description' AND a.object = '1-URGENT'""")
def matched_graph(spark, sf):
    """Urgent orders with an application, and their customers: a basic graph pattern."""
    rows = graph.statements(views.order_docs(spark, sf))
    return graph.match_bgp(rows, [
        ("?doc", S + "description", "1-URGENT"), ("?doc", S + "author", "?person"), ("?person", S + "name", "?customer"),
        ("?doc", S + "hasPart", "?app"), ("?app", TYPE, S + "SoftwareApplication"),
    ]).select("doc", "customer").distinct()


@query(f"""WITH o AS ({ORDERS}) SELECT doc AS doc_id, prop FROM (SELECT doc, prop, o_custkey, k FROM o, (VALUES ('about'), ('author')) v(prop))
WHERE k = (SELECT max(k) FROM o WHERE k % 3 = 0)""")
def subtree_nodes(spark, sf):
    """Occurrences of one node, asked for by its id."""
    last = views.table(spark, sf, "orders").filter("o_orderkey % 3 = 0").select(
        F.max_by(views.order_doc_id(), "o_orderkey").alias("d"))
    wanted = last.first()["d"] + "/customer"
    return nodes.subtree(views.order_docs(spark, sf), f"{CATALOG_PREFIX}:{wanted}").select("doc_id", "prop")


@query(f"""WITH o AS ({ORDERS}) SELECT k AS submission_id, CASE WHEN k % 11 = 3 THEN 'no context'
  WHEN k % 11 = 4 THEN 'no id' WHEN k % 11 = 5 THEN 'nested id outside the document' END AS reason
FROM o WHERE k % 11 IN (3, 4, 5)""")
def invalid_documents(spark, sf):
    """Documents that must not be published, with the reason."""
    k = F.col("submission_id")
    part = lambda home: F.struct(F.concat(home, F.lit("/part")).alias("@id"))
    body = lambda **f: F.to_variant_object(F.struct(*[v.alias(n.replace("at_", "@")) for n, v in f.items()]))
    context, doc = F.lit(DEFAULT.context), F.col("doc_id")
    docs = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("submission_id"), views.order_doc_id().alias("doc_id"))
    docs = docs.withColumn("body", F.when(k % 11 == 3, body(at_id=doc, hasPart=part(doc)))
                           .when(k % 11 == 4, body(at_context=context, name=doc))
                           .when(k % 11 == 5, body(at_context=context, at_id=doc, hasPart=part(F.lit("other"))))
                           .otherwise(body(at_context=context, at_id=doc, hasPart=part(doc))))
    _, rejects = documents.validate_documents(docs)
    return rejects.select("submission_id", "reason")


@query("""
WITH RECURSIVE v AS (SELECT 'region-' || r_regionkey AS class, 'Thing' AS parent FROM region
  UNION ALL SELECT 'nation-' || n_nationkey, 'region-' || n_regionkey FROM nation
  UNION ALL SELECT 'customer-' || c_custkey, 'nation-' || c_nationkey FROM customer),
c AS (SELECT class, class AS ancestor FROM (SELECT class FROM v UNION SELECT parent FROM v)
  UNION SELECT c.class, v.parent FROM c JOIN v ON v.class = c.ancestor)
SELECT class, ancestor FROM c""")
def class_closure(spark, sf):
    """Every class with all its ancestors."""
    return vocab.class_closure(views.vocabulary(spark, sf))


@query("""
SELECT 'customer-' || o_custkey AS type, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey = 1 GROUP BY 1""")
def subclass_orders(spark, sf):
    """Orders whose class lies below one region."""
    typed = views.table(spark, sf, "orders").select(views.text("customer-", F.col("o_custkey")).alias("type"))
    closure = vocab.class_closure(views.vocabulary(spark, sf))
    return vocab.is_subclass(typed, closure, "region-1").groupBy("type").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Given' WHEN p_partkey % 3 = 1 THEN 'range-' || p_type END AS type FROM part""")
def inferred_types(spark, sf):
    """Declared classes, else the range of the property, else none."""
    parts = views.table(spark, sf, "part")
    ranges = parts.select(F.col("p_type").alias("property"), views.text("range-", F.col("p_type")).alias("range"))
    n = F.col("p_partkey")
    typed = parts.select("p_partkey", F.when(n % 3 == 0, F.lit("Given")).alias("type"),
                         F.when(n % 3 == 2, F.lit("none")).otherwise(F.col("p_type")).alias("prop"))
    return vocab.infer_type(typed, ranges).select("p_partkey", "type")


@query("""
SELECT 'n' || c_nationkey || ':' || c_custkey AS curie, 'https://' || lower(n_name) || '.example/' || c_custkey AS iri,
  NULL AS reason FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_nationkey < 20
UNION ALL SELECT 'n' || c_nationkey || ':' || c_custkey, NULL, 'unsupported CURIE prefix: n' || c_nationkey
FROM customer WHERE c_nationkey >= 20""")
def joined_prefixes(spark, sf):
    """CURIEs expanded against a prefix table, unknown prefixes rejected."""
    prefixes = views.table(spark, sf, "nation").filter("n_nationkey < 20").select(
        views.text("n", F.col("n_nationkey")).alias("prefix"),
        views.text("https://", F.lower("n_name"), ".example/").alias("iri"))
    curies = views.table(spark, sf, "customer").select(
        views.text("n", F.col("c_nationkey"), ":", F.col("c_custkey")).alias("curie"))
    done, rejects = vocab.join_prefixes(curies, prefixes)
    return done.select("curie", "iri", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select("curie", F.lit(None).cast("string").alias("iri"), "reason"))


@query(STATEMENTS + "," + SHORT + """SELECT predicate, count(*) AS n FROM (SELECT DISTINCT * FROM cp) GROUP BY 1""")
def term_usage(spark, sf):
    """How often each term is used in the flattened documents."""
    return graph.flatten(views.order_docs(spark, sf)).groupBy("predicate").agg(F.count("*").alias("n"))



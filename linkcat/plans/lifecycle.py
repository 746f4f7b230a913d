"""Queries over versions, publishing, maintainers and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkcat.operators import catalog, maintainers, search, versions
from linkcat.plans import views
from linkcat.plans.registry import query

EVENTS = r"""
SELECT event_id, event_type, ts, user_id, 'u' || user_id AS doc_id,
  (CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) % 3) || '.' || (event_id % 11) || '.' || (event_id % 23)
    || CASE WHEN event_id % 13 = 5 THEN '-rc.' || (event_id % 4) ELSE '' END AS version,
  (CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) % 3) * 1000000000 + (event_id % 11) * 1000000 + (event_id % 23) * 1000
    + CASE WHEN event_id % 13 = 5 THEN event_id % 4 ELSE 999 END AS rank
FROM events"""


@query(f"SELECT doc_id, max_by(version, rank) AS version FROM ({EVENTS}) GROUP BY 1")
def latest_versions(spark, sf):
    """Latest version of each document."""
    return versions.latest_version(views.event_versions(spark, sf))


@query(f"""SELECT doc_id, max_by(version, rank) AS version FROM ({EVENTS})
WHERE rank < 2005000000 AND rank >= 1002000000 AND rank % 1000 = 999 GROUP BY 1""")
def range_versions(spark, sf):
    """Latest version of each document inside one range."""
    return versions.resolve_range(views.event_versions(spark, sf), ">=1.2.0 <2.5.0")


@query(f"""
WITH e AS ({EVENTS}), r AS (
  SELECT DISTINCT doc_id, user_id % 6 AS g FROM e),
hit AS (SELECT r.doc_id, g, e.version, rank FROM r JOIN e ON e.doc_id = r.doc_id AND CASE g
  WHEN 0 THEN true
  WHEN 1 THEN rank < 1003000999 AND rank % 1000 = 999
  WHEN 2 THEN rank >= 1000000999 AND rank < 2000000000 AND rank % 1000 = 999
  WHEN 3 THEN rank % 1000 = 999 AND ((rank >= 4000999 AND rank < 5000000) OR (rank >= 1004000999 AND rank < 1005000000))
  WHEN 4 THEN rank > 1005007000 AND rank < 2000000000 AND (rank % 1000 = 999 OR (rank // 1000 = 1005007))
  WHEN 5 THEN false END)
SELECT doc_id, (['', '<1.3.0', '^1.0.0', '~0.4.0 || 1.4.x', '>1.5.7-rc.0 <2.0.0', '>9.0.0'])[g + 1] AS range,
  max_by(version, rank) AS version FROM hit GROUP BY 1, 2""")
def requested_versions(spark, sf):
    """A different range asked of each document."""
    events = views.event_versions(spark, sf)
    ranges = ["", "<1.3.0", "^1.0.0", "~0.4.0 || 1.4.x", ">1.5.7-rc.0 <2.0.0", ">9.0.0"]
    asked = F.element_at(F.array(*[F.lit(r) for r in ranges]), (F.col("user_id") % 6 + 1).cast("int"))
    return versions.resolve_ranges(events, events.select("doc_id", asked.alias("range")))


@query(f"""SELECT DISTINCT doc_id, version FROM ({EVENTS}) WHERE event_id % 2 = 1 AND (doc_id, version) IN (
  SELECT (doc_id, version) FROM ({EVENTS}) WHERE event_id % 2 = 0)""")
def version_conflicts(spark, sf):
    """Versions submitted that are already published."""
    events = views.event_versions(spark, sf)
    _, conflicts = catalog.already_published(events.filter("event_id % 2 = 1"), events.filter("event_id % 2 = 0"))
    return conflicts.select("doc_id", "version").distinct()


PUBLISH = f"""
WITH e AS ({EVENTS}),
stored AS (SELECT DISTINCT doc_id, version FROM e WHERE event_id % 2 = 0),
sub AS (SELECT event_id AS submission_id, CASE WHEN event_type = 'view' THEN doc_id || '-live' ELSE doc_id END AS doc_id,
    CASE WHEN event_type = 'view' THEN NULL ELSE version END AS version, event_type <> 'error' AS valid, ts,
    CASE WHEN event_id % 5 = 0 THEN 'stranger' ELSE 'user' || user_id END AS username FROM e WHERE event_id % 2 = 1),
maint AS (SELECT DISTINCT 'u' || user_id AS namespace, 'user' || user_id AS username FROM events WHERE user_id % 3 <> 0),
own AS (SELECT doc_id AS namespace, arg_min(username, (ts, submission_id)) AS username FROM sub
  WHERE valid AND doc_id NOT IN (SELECT namespace FROM maint) GROUP BY 1),
grants AS (SELECT * FROM maint UNION SELECT * FROM own),
flagged AS (SELECT s.*, g.username IS NOT NULL AS ok FROM sub s LEFT JOIN grants g ON g.namespace = s.doc_id AND g.username = s.username),
numbered AS (SELECT *, CASE WHEN valid AND ok THEN row_number() OVER (PARTITION BY doc_id, version, valid AND ok ORDER BY ts, submission_id) END AS n,
  (doc_id, version) IN (SELECT (doc_id, version) FROM stored) AS present FROM flagged),
outcomes AS (SELECT submission_id, doc_id, version, username, CASE WHEN NOT valid THEN 'invalid' WHEN NOT ok THEN 'forbidden'
  WHEN version IS NULL AND n > 1 THEN 'updated' WHEN version IS NULL THEN 'created'
  WHEN n = 1 AND NOT present THEN 'created' ELSE 'conflict' END AS outcome, n FROM numbered)
"""


def _publish(spark, sf):
    return catalog.publish(views.submissions(spark, sf), views.stored_versions(spark, sf), views.event_maintainers(spark, sf))


@query(PUBLISH + "SELECT submission_id, doc_id, version, username, outcome FROM outcomes")
def publish_outcomes(spark, sf):
    """Outcome of every submission."""
    return _publish(spark, sf).outcomes.select("submission_id", "doc_id", "version", "username", "outcome")


@query(PUBLISH + """SELECT doc_id, version FROM stored UNION ALL SELECT doc_id, version FROM outcomes WHERE outcome = 'created'""")
def published_catalog(spark, sf):
    """Keys of the catalog after publishing."""
    return _publish(spark, sf).catalog.select("doc_id", "version")


@query(PUBLISH + "SELECT namespace, username FROM grants")
def granted_namespaces(spark, sf):
    """Maintainers after publishing: new namespaces go to their first publisher."""
    return _publish(spark, sf).maintainers


@query("""WITH o AS (SELECT *, 'c' || o_custkey || '/o' || o_orderkey AS doc, o_orderkey AS k FROM orders)
SELECT k AS submission_id, 'missing_media' AS outcome FROM o WHERE k % 5 = 0 OR k % 4 = 0""")
def missing_media(spark, sf):
    """Order documents whose media is neither on disk nor on the web."""
    docs = views.order_docs(spark, sf).withColumn(
        "submission_id", F.regexp_extract("doc_id", r"o(\d+)$", 1).cast("bigint"))
    lost = catalog.missing_media(docs, views.order_files(spark, sf), views.links(spark, sf))
    return lost.withColumn("outcome", F.lit("missing_media"))


@query(f"""WITH e AS (SELECT DISTINCT doc_id, version, user_id FROM ({EVENTS}) WHERE event_id % 2 = 0)
SELECT doc_id, version FROM e WHERE user_id % 4 <> 0 AND NOT (user_id % 4 = 1 AND version LIKE '1.%')""")
def unpublished_catalog(spark, sf):
    """Catalog after removing whole documents and single versions."""
    events = views.event_versions(spark, sf)
    removals = events.filter("user_id % 4 = 0").select("doc_id", F.lit(None).cast("string").alias("version")).unionByName(
        events.filter("user_id % 4 = 1 and version like '1.%'").select("doc_id", "version"))
    return catalog.unpublish(views.stored_versions(spark, sf), removals).select("doc_id", "version")


REQUESTS = """
SELECT DISTINCT 'ldr:u' || user_id || CASE user_id % 3 WHEN 0 THEN '' WHEN 1 THEN '?version=<1.4.0' ELSE '?version=>9.0.0' END AS request,
  'u' || user_id AS doc_id, user_id % 3 AS g FROM events"""


def _requests(spark, sf):
    u = F.col("user_id")
    suffix = F.when(u % 3 == 0, F.lit("")).when(u % 3 == 1, F.lit("?version=<1.4.0")).otherwise(F.lit("?version=>9.0.0"))
    return views.table(spark, sf, "events").select(views.text("ldr:u", u, suffix).alias("request")).distinct()


@query(f"""SELECT request, q.doc_id, max_by(version, rank) AS version FROM ({REQUESTS}) q JOIN ({EVENTS}) e ON e.doc_id = q.doc_id
WHERE event_id % 2 = 0 AND (g = 0 OR (g = 1 AND rank < 1004000999 AND rank % 1000 = 999)) GROUP BY 1, 2""")
def fetched_documents(spark, sf):
    """Documents that answer requests with and without ranges."""
    found, _ = catalog.get(views.stored_versions(spark, sf), _requests(spark, sf))
    return found.select("request", "doc_id", "version")


@query(f"""SELECT request, 'not found' AS reason FROM ({REQUESTS}) q WHERE NOT EXISTS (SELECT 1 FROM ({EVENTS}) e
WHERE e.doc_id = q.doc_id AND event_id % 2 = 0 AND (g = 0 OR (g = 1 AND rank < 1004000999 AND rank % 1000 = 999)))""")
def missing_documents(spark, sf):
    """Requests that nothing answers."""
    _, missing = catalog.get(views.stored_versions(spark, sf), _requests(spark, sf))
    return missing.select("request", "reason")


@query(f"""SELECT request, 'ldr:' || q.doc_id AS id, '{{"@id":"ldr:' || q.doc_id || '","name":"document of ' || q.doc_id || '","version":"'
  || max_by(version, rank) || '"}}' AS node FROM ({REQUESTS}) q JOIN ({EVENTS}) e ON e.doc_id = q.doc_id
WHERE event_id % 2 = 0 AND (g = 0 OR (g = 1 AND rank < 1004000999 AND rank % 1000 = 999)) GROUP BY 1, q.doc_id""")
def shown_documents(spark, sf):
    """Requested documents in compacted form."""
    return catalog.show(views.stored_versions(spark, sf), _requests(spark, sf)).select("request", "id", "node")


@query("""
SELECT lower(n_name) AS namespace, 'cust' || c_custkey AS username, 'ldr:users/cust' || c_custkey AS person_id,
  'Person' AS person_type, 'mailto:cust' || c_custkey || '@shop.example' AS email
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 2 = 0 AND c_custkey % 7 <> 0""")
def listed_maintainers(spark, sf):
    """Persons that maintain each namespace."""
    return maintainers.list_maintainers(views.nation_maintainers(spark, sf), views.users(spark, sf))


@query("""
SELECT lower(n_name) AS namespace, 'cust' || c_custkey AS username FROM customer JOIN nation ON n_nationkey = c_nationkey
WHERE c_custkey % 2 = 0 OR (c_custkey % 3 = 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 7 <> 0)""")
def added_maintainers(spark, sf):
    """Maintainers after granting rights."""
    changes = maintainers.with_namespace(views.grants(spark, sf))
    return maintainers.add_maintainers(views.nation_maintainers(spark, sf), changes, views.users(spark, sf))[0]


@query("""
SELECT CASE WHEN c_custkey % 11 <> 0 THEN 'cust' || c_custkey END AS username,
  CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN 'username and namespace are required' ELSE 'unknown user' END AS reason
FROM customer WHERE c_custkey % 3 = 0 AND (c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 7 = 0)""")
def refused_grants(spark, sf):
    """Grants refused: incomplete ones and unknown users."""
    changes = maintainers.with_namespace(views.grants(spark, sf))
    _, refused = maintainers.add_maintainers(views.nation_maintainers(spark, sf), changes, views.users(spark, sf))
    return refused.select("username", "reason")


@query("""
SELECT lower(n_name) AS namespace, 'cust' || c_custkey AS username FROM customer JOIN nation ON n_nationkey = c_nationkey
WHERE c_custkey % 2 = 0 AND NOT (c_custkey % 3 = 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0)""")
def removed_maintainers(spark, sf):
    """Maintainers after revoking rights."""
    changes = maintainers.with_namespace(views.grants(spark, sf))
    return maintainers.remove_maintainers(views.nation_maintainers(spark, sf), changes)


@query("""SELECT o_orderkey, c_custkey % 2 = 0 AS allowed FROM orders JOIN customer ON c_custkey = o_custkey""")
def authorized_orders(spark, sf):
    """Orders as changes, by whether the customer maintains the nation's namespace."""
    nation = views.table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("namespace"))
    changes = (
        views.table(spark, sf, "orders").join(views.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "namespace", views.text("cust", F.col("c_custkey")).alias("username")))
    allowed, refused = maintainers.authorize(changes, views.nation_maintainers(spark, sf))
    return allowed.select("o_orderkey", F.lit(True).alias("allowed")).unionByName(
        refused.select("o_orderkey", F.lit(False).alias("allowed")))


@query("""
SELECT 'cust' || c_custkey AS username, 'mailto:' || CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE 'cust' END || c_custkey || '@shop.example' AS email,
  CASE WHEN c_custkey % 7 = 0 THEN 'created' WHEN c_custkey % 5 = 0 THEN 'clash' ELSE 'existing' END AS outcome
FROM customer WHERE c_custkey % 2 = 0""")
def registered_users(spark, sf):
    """Outcome of registering users, some known already."""
    c = F.col("c_custkey")
    new = views.table(spark, sf, "customer").filter("c_custkey % 2 = 0").select(
        views.text("cust", c).alias("username"),
        views.text("mailto:", F.when(c % 5 == 0, F.lit("x")).otherwise(F.lit("cust")), c, "@shop.example").alias("email"))
    return maintainers.upsert_users(views.users(spark, sf), new)[1]


WORDS = r"""
SELECT 'd' || doc_id AS doc_id, source AS name, list_distinct(list_filter(regexp_split_to_array(lower(lang || ' ' || source || ' ' || text),
  '[^\p{L}\p{N}_]+'), lambda x: x <> '')) AS terms FROM documents"""


@query(f"""SELECT doc_id, 'Article' AS type, name, '1.0.0' AS version, len(list_intersect(terms, ['src3', 'fr', 'thetion'])) AS n_terms
FROM ({WORDS}) WHERE list_has_any(terms, ['src3', 'fr', 'thetion'])""")
def search_any(spark, sf):
    """Documents with any of the keywords."""
    return search.search(views.searchable(spark, sf), [" SRC3 ", "fr", "thetion"]).drop("description")


@query(f"""SELECT doc_id, '1.0.0' AS version, 2 AS n_terms FROM ({WORDS}) WHERE list_has_all(terms, ['src3', 'fr'])""")
def search_all(spark, sf):
    """Documents with all of the keywords, from the index."""
    found = search.search_index(search.index_terms(views.searchable(spark, sf)), ["src3", "FR"], mode="all")
    return found.select("doc_id", "version", "n_terms")


@query(f"SELECT term, count(*) AS n FROM (SELECT unnest(terms) AS term FROM ({WORDS})) GROUP BY 1")
def term_index(spark, sf):
    """Size of every posting list of the index."""
    return search.index_terms(views.searchable(spark, sf)).groupBy("term").agg(F.count("*").alias("n"))


@query(f"SELECT count(*) AS n_results FROM ({WORDS}) WHERE list_has_any(terms, ['de', 'the'])")
def search_count(spark, sf):
    """Number of documents found."""
    return search.search_count(search.search(views.searchable(spark, sf), ["de", "the"]))

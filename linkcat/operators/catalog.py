"""Life of a catalog: publish, unpublish, get. Every step is table in, table out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkcat.config import DEFAULT, Catalog
from linkcat.functions import urls
from linkcat.operators import bodies, graph, media, nodes
from linkcat.operators.documents import validate_documents
from linkcat.operators.versions import only_documents, resolve_ranges
from linkcat.session import durable

KEY = ["doc_id", "version"]
STORED = ("doc_id", "version", "body", "published_at")


class Published(NamedTuple):
    """The catalog after publishing, an outcome per submission, and the new maintainers.

    ``added`` and ``replaced`` (documents whose unversioned row goes) are the change alone, for a store that
    is not rewritten. ``media`` and ``files`` say what was archived for the added documents, if digests were given, and
    ``conflicts`` which paths have digests that contradict each other, so that nothing was archived for them.
    """

    catalog: DataFrame
    outcomes: DataFrame
    maintainers: DataFrame
    added: DataFrame
    replaced: DataFrame
    media: DataFrame | None = None
    files: DataFrame | None = None
    conflicts: DataFrame | None = None


def with_keys(submissions: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Submissions with ``doc_id``, ``version`` and ``namespace`` read from their body."""
    name = nodes.node_iri(nodes.text_at(F.col("body"), "$['@id']"), catalog)
    doc_id = F.substring(name, F.lit(len(catalog.base) + 1), F.length(name))
    return submissions.withColumn("doc_id", doc_id).withColumn(
        "version", nodes.text_at(F.col("body"), "$.version")
    ).withColumn("namespace", F.split_part("doc_id", F.lit("/"), F.lit(1)))


def already_published(new: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose (document, version) is free, and those that conflict."""
    keys = stored.select(*KEY).distinct()
    return new.join(keys, KEY, "left_anti"), new.join(keys, KEY, "left_semi")


def missing_media(submissions: DataFrame, files: DataFrame, responses: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Submissions with media that has neither all its files nor a URL that answers."""
    found = durable(nodes.media_nodes(submissions.select("submission_id", "body")))
    keys = ["submission_id", "path"]
    lacking = media.refresh_media(found, files).filter(~F.col("found")).select(*keys).distinct()
    # A URL given instead of a file is taken as it is; only lost files fall back to their URL.
    fallback = found.join(lacking, keys, "left_semi")
    dead = media.check_links(fallback, responses, catalog).filter("reason is not null")
    return dead.select("submission_id").distinct()


def publish(
    submissions: DataFrame,
    stored: DataFrame,
    maintainers: DataFrame,
    files: DataFrame | None = None,
    responses: DataFrame | None = None,
    catalog: Catalog = DEFAULT,
    digested: DataFrame | None = None,
) -> Published:
    """Publish submissions ``(submission_id, username, body, published_at)``.

    ``files`` and ``digested`` (see ``media.archive``) may name the ``submission_id`` that a path belongs to.

    Outcomes: invalid, forbidden, missing_media, conflict, created, updated. A namespace nobody
    maintains goes to the first valid publisher. Of several submissions of one version the
    earliest wins; without a version the latest replaces what was there.
    """
    keyed = with_keys(submissions, catalog)
    _, rejects = validate_documents(keyed, catalog)
    at = F.struct("published_at", "submission_id")

    # Bodies are walked once; every later step works on stored narrow rows.
    rows = durable(
        keyed.select("submission_id", "username", "namespace", *KEY, "published_at")
        .join(rejects.select("submission_id", "reason"), "submission_id", "left"))
    narrow = rows.filter("reason is null").drop("reason")
    owners = (
        narrow.join(maintainers.select("namespace").distinct(), "namespace", "left_anti")
        .groupBy("namespace").agg(F.min_by("username", at).alias("username"))
    )
    grants = maintainers.select("namespace", "username").unionByName(
        owners.select("namespace", "username")).distinct()
    eligible = narrow.join(grants, ["namespace", "username"], "left_semi")
    allowed = eligible
    if files is not None and responses is not None:
        dead = missing_media(
            submissions.join(eligible.select("submission_id"), "submission_id", "left_semi"),
            files, responses, catalog)
        allowed = eligible.join(dead, "submission_id", "left_anti")

    versioned = allowed.filter("version is not null")
    winners = versioned.groupBy(*KEY).agg(F.min(at).alias("_at")).select(*KEY, F.col("_at.submission_id").alias("submission_id"))
    new_versions, _ = already_published(winners, stored.filter("version is not null"))

    plain = allowed.filter("version is null")
    present = stored.filter("version is null").select("doc_id").distinct()
    ends = plain.groupBy("doc_id").agg(
        F.min(at).alias("_first"), F.max(at).alias("_last"))
    firsts = ends.join(present, "doc_id", "left_anti").select(F.col("_first.submission_id").alias("submission_id"))
    lasts = ends.select("doc_id", F.col("_last.submission_id").alias("submission_id"))

    flag = lambda df, name: df.select("submission_id").withColumn(name, F.lit(True))
    outcome = (
        F.when(F.col("_valid").isNull(), F.lit("invalid"))
        .when(F.col("_eligible").isNull(), F.lit("forbidden"))
        .when(F.col("_allowed").isNull(), F.lit("missing_media"))
        .when(F.col("_created"), F.lit("created"))
        .when(F.col("version").isNull(), F.lit("updated"))
        .otherwise(F.lit("conflict"))
    )
    outcomes = rows.select("submission_id", *KEY, "namespace", "username")
    created = flag(new_versions.select("submission_id").unionByName(firsts), "_created")
    for flags in (flag(narrow, "_valid"), flag(eligible, "_eligible"), flag(allowed, "_allowed"), created):
        outcomes = outcomes.join(flags, "submission_id", "left")
    outcomes = outcomes.select("submission_id", *KEY, "namespace", "username", outcome.alias("outcome"))

    accepted = new_versions.select("submission_id").unionByName(lasts.select("submission_id"))
    if digested is not None:  # what is archived and what is added both read these
        accepted = durable(accepted)
    accepted_rows = with_keys(submissions.join(accepted, "submission_id", "left_semi"), catalog)
    added = accepted_rows.select(*STORED)
    replaced = lasts.select("doc_id")
    kept_versions = stored.filter("version is not null")
    kept_plain = stored.filter("version is null").join(replaced, "doc_id", "left_anti")
    after = kept_versions.unionByName(kept_plain.select(*kept_versions.columns)).select(*STORED).unionByName(added)
    if digested is None:
        return Published(after, outcomes, grants, added, replaced)
    found = durable(nodes.media_nodes(accepted_rows.select("submission_id", *KEY, "body")))
    return Published(after, outcomes, grants, added, replaced,
                     media.archive(found, digested).drop("submission_id"), media.archived_files(found, digested).drop("submission_id", "path"),
                     media.split_duplicates(digested.select(*media.file_keys(found, digested), "path", *media.DIGESTS), media.file_keys(found, digested))[1])


def with_archive(docs: DataFrame, files: DataFrame, digested: DataFrame, uploaded_at: Column | None = None) -> DataFrame:
    """Documents ``(doc_id, version, body, ...)`` with what archiving found out written into their media nodes.

    ``files`` and ``digested`` (see ``media.archive``) may name the ``doc_id`` and ``version`` that a path belongs to.
    """
    keys = [c for c in KEY if c in docs.columns]
    found = durable(nodes.media_nodes(docs.select(*keys, "body")))
    return bodies.set_entries(docs, bodies.archived_entries(found, files, digested, uploaded_at), keys)


def unpublish(stored: DataFrame, removals: DataFrame) -> DataFrame:
    """Remove versions: rows ``(doc_id, version)``; a NULL version removes every one."""
    whole = removals.filter("version is null").select("doc_id").distinct()
    single = removals.filter("version is not null").select(*KEY).distinct()
    return stored.join(whole, "doc_id", "left_anti").join(single, KEY, "left_anti")


def parse_requests(requests: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Requests ``(request)`` such as ``ldr:mydoc?version=<2.1.0`` as ``doc_id`` and ``range``."""
    ref = F.split_part("request", F.lit("?version="), F.lit(1))
    url = urls.resolve_curie(ref, catalog)["url"]
    return requests.withColumn(
        "doc_id", F.when(url.startswith(catalog.base), urls.strip_slashes(urls.url_path(url)))
    ).withColumn("range", F.nullif(F.split_part("request", F.lit("?version="), F.lit(2)), F.lit("")))


def get(stored: DataFrame, requests: DataFrame, catalog: Catalog = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Documents that answer requests, and the requests nothing answers.

    The latest version (or one in the asked range) answers; documents without versions answer
    requests that ask for none.
    """
    asked = parse_requests(requests, catalog).select("request", "doc_id", "range")
    stored = only_documents(stored, asked)
    keys = stored.select(*[c for c in (*KEY, "version_key") if c in stored.columns])
    answers = resolve_ranges(keys, asked).select(
        F.col("doc_id").alias("_d"), F.col("range").alias("_r"), "version")
    chosen = asked.join(
        answers, (F.col("doc_id") == F.col("_d")) & F.col("range").eqNullSafe(F.col("_r")), "left"
    ).select("request", "doc_id", "range", "version")
    bodies = stored.select(*[F.col(c).alias(f"_{c}") for c in STORED if c in stored.columns])
    found = chosen.join(
        bodies,
        (F.col("doc_id") == F.col("_doc_id")) & F.col("version").eqNullSafe(F.col("_version"))
        & (F.col("version").isNotNull() | F.col("range").isNull()),
    ).select("request", "doc_id", "version", F.col("_body").alias("body"))
    missing = requests.join(found.select("request").distinct(), "request", "left_anti").withColumn(
        "reason", F.lit("not found"))
    return found, missing


def show(stored: DataFrame, requests: DataFrame, profile: str = "compacted", catalog: Catalog = DEFAULT) -> DataFrame:
    """Requested documents in one of the JSON-LD forms; the compacted one of whole documents is the profile ``document``."""
    found, _ = get(stored, requests, catalog)
    return graph.as_profile(found.select("request", "doc_id", "version", "body"), profile, catalog)

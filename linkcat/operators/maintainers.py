"""Users, and who may publish in which namespace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkcat.config import CATALOG_PREFIX, DEFAULT, Catalog
from linkcat.functions.urls import namespace_of

GRANT = ["namespace", "username"]


def list_maintainers(maintainers: DataFrame, users: DataFrame) -> DataFrame:
    """Persons of each namespace, one row per maintainer, in name order."""
    return maintainers.join(users, "username").select(
        "namespace", "username", F.col("id").alias("person_id"), F.col("type").alias("person_type"), "email",
    ).orderBy("namespace", "username")


def with_namespace(changes: DataFrame, catalog: Catalog = DEFAULT) -> DataFrame:
    """Changes given by document CURIE, with the namespace it belongs to."""
    return changes.withColumn("namespace", namespace_of(F.col("curie"), catalog))


def incomplete(changes: DataFrame) -> DataFrame:
    """Changes that lack a user or a namespace."""
    return changes.filter("username is null or namespace is null").withColumn(
        "reason", F.lit("username and namespace are required"))


def maintainer_exists(changes: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes that name a registered user, and the others with a reason."""
    known = users.select("username").distinct()
    return changes.join(known, "username", "left_semi"), changes.join(known, "username", "left_anti").withColumn(
        "reason", F.lit("unknown user"))


def authorize(changes: DataFrame, maintainers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changes made by a maintainer of the namespace, and the others with a reason."""
    grants = maintainers.select(*GRANT).distinct()
    return changes.join(grants, GRANT, "left_semi"), changes.join(grants, GRANT, "left_anti").withColumn(
        "reason", F.lit("not a maintainer"))


def add_maintainers(maintainers: DataFrame, changes: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Grant rights: the new table, and rejected changes."""
    complete = changes.filter("username is not null and namespace is not null")
    known, unknown = maintainer_exists(complete, users)
    granted = maintainers.select(*GRANT).unionByName(known.select(*GRANT)).distinct()
    return granted, incomplete(changes).unionByName(unknown, allowMissingColumns=True)


def remove_maintainers(maintainers: DataFrame, changes: DataFrame) -> DataFrame:
    """Revoke rights."""
    return maintainers.join(changes.select(*GRANT).distinct(), GRANT, "left_anti")


def upsert_users(users: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Register users ``(username, email)``: the new table and an outcome per request.

    A known user with the same address is returned as existing, another address is a clash;
    among several requests for a new name the smallest address is registered.
    """
    person = new.groupBy("username").agg(F.min("email").alias("_email"))
    fresh = person.join(users.select("username"), "username", "left_anti").select(
        "username",
        F.concat(F.lit(f"{CATALOG_PREFIX}:users/"), "username").alias("id"),
        F.lit("Person").alias("type"),
        F.col("_email").alias("email"),
    )
    current = users.select("username", F.col("email").alias("_have"), F.lit(False).alias("_new")).unionByName(
        fresh.select("username", F.col("email").alias("_have"), F.lit(True).alias("_new")))
    outcome = (
        F.when(F.col("email") != F.col("_have"), F.lit("clash"))
        .when(F.col("_new"), F.lit("created")).otherwise(F.lit("existing"))
    )
    outcomes = new.join(current, "username").select("username", "email", outcome.alias("outcome"))
    return users.unionByName(fresh), outcomes

"""Access report: a principal's entity set joined with privileges and
table ownership, plus the expansion of grants down the
catalog → schema → table hierarchy.

Input frames (FIXTURES.md §3): ``membership(member, name)``,
``catalog_privileges``, ``schema_privileges``, ``table_privileges``,
``tables``; the entity set is ``(entity, entity_type)``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.predicates import older_than

# The metadata schema excluded from schema reports, and the
# inherited_from marker of an explicit grant.
METADATA_SCHEMA = "information_schema"
EXPLICIT = "NONE"
# Fixed values (ours): markers of grants inherited from a catalog or schema.
FROM_CATALOG = "CATALOG"
FROM_SCHEMA = "SCHEMA"

# The columns of the reports.
SCHEMA_REPORT_COLUMNS = ["catalog_name", "schema_name", "grantor", "privilege_type"]
TABLE_REPORT_COLUMNS = ["table_catalog", "table_schema", "table_name", "last_altered",
                        "last_altered_by", "created", "storage_sub_directory"]


def groups_of_user(membership: DataFrame, user: str) -> DataFrame:
    """``SHOW GROUPS WITH USER u``: one row per group of the user."""
    return membership.filter(F.col("member") == F.lit(user)).select("name")


def entity_set(membership: DataFrame, user: str) -> DataFrame:
    """The user (type ``user``) UNION their groups (type ``group``), distinct. It is small, which
    Spark sees at run time and broadcasts it to the reports."""
    spark = membership.sparkSession
    me = spark.createDataFrame([(user, "user")], "entity string, entity_type string")
    groups = groups_of_user(membership, user).select(
        F.col("name").alias("entity"), F.lit("group").alias("entity_type"))
    return me.union(groups).distinct()


def catalog_access(catalog_privileges: DataFrame, entities: DataFrame) -> DataFrame:
    """Catalog privileges held by any entity: all columns of both sides."""
    e = entities
    return catalog_privileges.join(e, catalog_privileges["grantee"] == e["entity"], "inner")


def _schema_rows(schema_privileges: DataFrame, entities: DataFrame) -> DataFrame:
    e = entities
    sp = schema_privileges.filter(F.col("schema_name") != F.lit(METADATA_SCHEMA))
    return sp.join(e, sp["grantee"] == e["entity"], "inner")


def schema_access_explicit(schema_privileges: DataFrame, entities: DataFrame) -> DataFrame:
    """Schema grants made directly (``inherited_from = 'NONE'``), sorted."""
    rows = _schema_rows(schema_privileges, entities)
    return (rows.filter(F.col("inherited_from") == F.lit(EXPLICIT))
                .select(*SCHEMA_REPORT_COLUMNS)
                .orderBy("catalog_name", "schema_name"))


def schema_access_inherited(schema_privileges: DataFrame, entities: DataFrame) -> DataFrame:
    """Schema grants inherited from above, with the entity they come through."""
    rows = _schema_rows(schema_privileges, entities)
    return (rows.filter(F.col("inherited_from") != F.lit(EXPLICIT))
                .select(*SCHEMA_REPORT_COLUMNS,
                        F.col("entity").alias("EntityInheritedFrom"),
                        "entity_type", "inherited_from")
                .orderBy("catalog_name", "schema_name"))


def table_access(table_privileges: DataFrame, entities: DataFrame) -> DataFrame:
    """Table privileges held by any entity: all columns of both sides."""
    e = entities
    return table_privileges.join(e, table_privileges["grantee"] == e["entity"], "inner")


def owned_tables(tables: DataFrame, entities: DataFrame) -> DataFrame:
    """Tables whose owner is in the entity set.

    Only table columns are returned and the entity set is distinct, so the
    inner join is a semi join; Catalyst can push a semi join below the
    joins that build ``tables`` (down to the owner's side).
    """
    e = entities
    return (tables.join(e, tables["table_owner"] == e["entity"], "left_semi")
                  .select(*TABLE_REPORT_COLUMNS))


def stale_tables(tables: DataFrame, entities: DataFrame,
                 as_of: str | dt.datetime | Column, days: int = 30) -> DataFrame:
    """Owned tables last altered at least ``days`` before ``as_of``."""
    return owned_tables(tables.filter(older_than("last_altered", as_of, days)), entities)


# --- grants as rows, expanded down the hierarchy -------------------------

def expand_catalog_grants(catalog_grants: DataFrame, schemas: DataFrame) -> DataFrame:
    """Catalog-level grants repeated on every schema of the catalog.

    ``schemas(catalog_name, schema_name)``. Output has the schema privilege
    columns with ``inherited_from = 'CATALOG'``.
    """
    g = catalog_grants.select("grantor", "grantee", "catalog_name", "privilege_type")
    return (g.join(schemas, "catalog_name")
             .select("grantor", "grantee", "catalog_name", "schema_name",
                     "privilege_type", F.lit(FROM_CATALOG).alias("inherited_from")))


def schema_privileges(schema_grants: DataFrame, catalog_grants: DataFrame,
                      schemas: DataFrame) -> DataFrame:
    """Explicit schema grants (``'NONE'``) plus those inherited from catalogs."""
    explicit = schema_grants.select("grantor", "grantee", "catalog_name", "schema_name",
                                    "privilege_type",
                                    F.lit(EXPLICIT).alias("inherited_from"))
    return explicit.unionByName(expand_catalog_grants(catalog_grants, schemas))


def table_privileges(schema_privs: DataFrame, tables: DataFrame,
                     entities: DataFrame | None = None) -> DataFrame:
    """Schema privileges repeated on every table of the schema.

    When ``entities`` is given the privileges are narrowed to them *before*
    the expansion, since the full grants × tables product is large. A grant
    made on the schema shows as inherited from ``'SCHEMA'``; one that came
    from the catalog keeps ``'CATALOG'``.
    """
    sp = schema_privs
    if entities is not None:
        e = entities
        sp = sp.join(e, sp["grantee"] == e["entity"], "left_semi")
    t = tables.select(F.col("table_catalog").alias("catalog_name"),
                      F.col("table_schema").alias("schema_name"), "table_name")
    return (sp.join(t, ["catalog_name", "schema_name"])
              .select("grantor", "grantee", "catalog_name", "schema_name", "table_name",
                      "privilege_type",
                      F.when(F.col("inherited_from") == F.lit(EXPLICIT), F.lit(FROM_SCHEMA))
                       .otherwise(F.col("inherited_from")).alias("inherited_from")))

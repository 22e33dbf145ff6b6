"""Table sinks in the session catalog: layers (databases), typed tables with additive schema
evolution, full rebuilds (CTAS) and table descriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from hebdo.session import unique_suffix

# Warehouse type names and their Spark types (synonyms compare equal).
TYPE_SYNONYMS = {
    "INT64": "bigint", "INTEGER": "bigint", "INT": "bigint", "BIGINT": "bigint",
    "FLOAT64": "double", "FLOAT": "double", "DOUBLE": "double",
    "STRING": "string", "DATE": "date", "TIMESTAMP": "timestamp", "BOOL": "boolean",
    "BOOLEAN": "boolean",
}


class SchemaConflict(ValueError):
    pass


def spark_type(name: str) -> DataType:
    return DataType.fromDDL(TYPE_SYNONYMS.get(name.upper(), name))


def schema_from_fields(fields: list[tuple[str, str, bool]]) -> StructType:
    """(name, type name, required) triples -> StructType (warehouse names accepted)."""
    return StructType([StructField(n, spark_type(t), not req) for n, t, req in fields])


def ensure_layer(spark: SparkSession, name: str, comment: str = "", location: str | None = None) -> None:
    """Create the database if absent, in the warehouse folder unless a location is given."""
    where = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {quoted(comment)}{where}")


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def schema_diff(existing: StructType, wanted: StructType) -> tuple[list[StructField], list[str]]:
    """(fields to add, conflicts): same name with another type is a conflict."""
    have = {f.name.lower(): f for f in existing.fields}
    add, conflicts = [], []
    for f in wanted.fields:
        cur = have.get(f.name.lower())
        if cur is None:
            add.append(f)
        elif cur.dataType != f.dataType:
            conflicts.append(f"{f.name}: {cur.dataType.simpleString()} != {f.dataType.simpleString()}")
    return add, conflicts


# Parquet reads every column back as nullable, so the catalog keeps which ones are required; it also
# keeps the clustering.
REQUIRED, CLUSTERED = "hebdo.required_columns", "hebdo.cluster_columns"


def _property(spark: SparkSession, name: str, key: str) -> list[str]:
    rows = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return [c for c in rows.get(key, "").split(",") if c]


def required_columns(spark: SparkSession, name: str) -> list[str]:
    return _property(spark, name, REQUIRED)


def cluster_columns(spark: SparkSession, name: str) -> list[str]:
    return _property(spark, name, CLUSTERED)


def clustered(df: DataFrame, partition_cols: list[str], cluster_cols: list[str]) -> DataFrame:
    """Rows dealt out by range of the partition and cluster columns and sorted by them, so each written file
    holds one stretch and the statistics of files and row groups prune on these columns."""
    order = list(dict.fromkeys([*partition_cols, *cluster_cols]))
    return df.repartitionByRange(*order).sortWithinPartitions(*order) if cluster_cols else df


def ensure_table(spark: SparkSession, name: str, schema: StructType, partition_cols: list[str] | None = None,
                 comment: str = "", cluster_cols: list[str] | None = None) -> list[str]:
    """Create the table if absent; else add missing columns. A changed type or mode (required or
    not), other partition or cluster columns, or a new required column fail. Returns the names of
    added columns. ``append`` writes in the order of the cluster columns."""
    required = [f.name for f in schema.fields if not f.nullable]
    if unknown := set(cluster_cols or []) - set(schema.names):
        raise SchemaConflict(f"{name}: no columns {sorted(unknown)} to cluster by")
    if not spark.catalog.tableExists(name):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
        cmt = f" COMMENT {quoted(comment)}" if comment else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{part}{cmt} "
                  f"TBLPROPERTIES ({quoted(REQUIRED)} = {quoted(','.join(required))}, "
                  f"{quoted(CLUSTERED)} = {quoted(','.join(cluster_cols or []))})")
        return [f.name for f in schema.fields]
    add, conflicts = schema_diff(spark.table(name).schema, schema)
    new = {f.name.lower() for f in add}
    had = {c.lower() for c in required_columns(spark, name)}
    for f in schema.fields:
        if f.name.lower() in new:
            conflicts += [f"{f.name}: a new column cannot be required"] if not f.nullable else []
        elif (f.name.lower() in had) == f.nullable:
            conflicts.append(f"{f.name}: {'required' if f.nullable else 'nullable'} in the table")
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if partition_cols is not None and parts != list(partition_cols):
        conflicts.append(f"partitioned by {parts}, not {list(partition_cols)}")
    if cluster_cols is not None and cluster_columns(spark, name) != list(cluster_cols):
        conflicts.append(f"clustered by {cluster_columns(spark, name)}, not {list(cluster_cols)}")
    if conflicts:
        raise SchemaConflict(f"{name}: " + "; ".join(conflicts))
    if add:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in add)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    return [f.name for f in add]


def check_required(df: DataFrame, required: list[str]) -> None:
    """Fail when a required column holds a NULL (Parquet reads every column back nullable)."""
    cond = None
    for c in required:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    if cond is not None and not df.filter(cond).isEmpty():
        raise ValueError(f"NULL in required columns {required}")


def append(df: DataFrame, name: str) -> None:
    """Append rows by column name (missing columns written as NULL), clustered as the table is. A column
    that the table lacks (``ensure_table`` adds columns), or a NULL in a required one, fails before
    anything is written."""
    spark = df.sparkSession
    target = spark.table(name).schema
    have = {f.name.lower() for f in target.fields}
    if extra := [c for c in df.columns if c.lower() not in have]:
        raise SchemaConflict(f"{name}: the table has no columns {extra}")
    required = required_columns(spark, name)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns {missing} are missing")
    check_required(df, required)
    cols = [F.col(f.name).cast(f.dataType) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    clustered(df.select(*cols), parts, cluster_columns(spark, name)).write.insertInto(name)


# ---------------------------------------------------------------------------------------
# Full rebuilds. The rows of a rebuild go to a table of their own, ``<name>__v_<suffix>``, and ``<name>`` is a
# view of it. Replacing the view is one change of the catalog, so readers see the old rows or the new
# ones; a run that dies before leaves the old ones. The version before the newest stays for readers
# that began earlier.

def _version_tables(spark: SparkSession, name: str) -> list[str]:
    db, _, table = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES{f' IN {db}' if db else ''} LIKE '{table}__v_*'").collect()
    return [f"{db}.{r['tableName']}" if db else r["tableName"] for r in rows if not r["isTemporary"]]


def current_version(spark: SparkSession, name: str) -> str | None:
    """The table behind ``name``; None if there is none yet."""
    if not spark.catalog.tableExists(name):
        return None
    if spark.catalog.getTable(name).tableType != "VIEW":
        return name
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((r["value"] for r in rows if r["key"] == VERSION), None)


VERSION = "hebdo.version"


def create_or_replace_table(df: DataFrame, name: str, partition_cols: list[str] | None = None,
                            comment: str | None = None, cluster_cols: list[str] | None = None) -> None:
    """Full rebuild of ``name`` from ``df``, whose plan may read it. Readers see the rows of before until
    all new ones are written."""
    spark = df.sparkSession
    old = current_version(spark, name)
    kept = description(spark, name) if comment is None and old else comment
    version = f"{name}__v_{unique_suffix().replace('-', '_')}"
    w = clustered(df, list(partition_cols or []), list(cluster_cols or [])).write.format("parquet")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(version)
    if old == name:  # a table from elsewhere makes room for the view; its rows stay as a version
        old = f"{name}__v_before_{unique_suffix().replace('-', '_')}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    cmt = f" COMMENT {quoted(kept)}" if kept else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{cmt} TBLPROPERTIES ({quoted(VERSION)} = {quoted(version)}) AS SELECT * FROM {version}")
    for table in _version_tables(spark, name):
        if table.split(".")[-1] not in {t.split(".")[-1] for t in (version, old) if t}:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def set_description(spark: SparkSession, name: str, text: str) -> None:
    """Table description; a later call replaces the earlier one."""
    kind = "VIEW" if spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
    spark.sql(f"ALTER {kind} {name} SET TBLPROPERTIES ('comment' = {quoted(text)})")


def description(spark: SparkSession, name: str) -> str | None:
    """The table comment (``TBLPROPERTIES ('comment' = ...)`` sets the comment itself)."""
    return spark.catalog.getTable(name).description

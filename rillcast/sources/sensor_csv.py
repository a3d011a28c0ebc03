"""Sensor CSV files with a descriptive comment header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillcast.operators.scan import literal_rows
from rillcast.sources.staged import per_key

# Fixed values: (section, key) of the header and the staging column it fills.
HEADER_KEYS = (
    ("Workspace", "Name", "workspace_name"),
    ("Workspace", "Owner", "owner_name"),
    ("Workspace", "Contact Email", "contact_email"),
    ("Site Information", "Name", "site_name"),
    ("Site Information", "Description", "site_description"),
    ("Site Information", "SamplingFeatureType", "sampling_feature_type"),
    ("Site Information", "SamplingFeatureCode", "site_code"),
    ("Site Information", "SiteType", "site_type"),
    ("Location Information", "Latitude", "latitude"),
    ("Location Information", "Longitude", "longitude"),
    ("Location Information", "Elevation_m", "elevation_m"),
    ("Location Information", "ElevationDatum", "elevation_datum"),
    ("Location Information", "State", "state"),
    ("Location Information", "County", "county"),
    ("Datastream Information", "Name", "datastream_name"),
    ("Datastream Information", "Description", "datastream_description"),
    ("Datastream Information", "ObservationType", "observation_type"),
    ("Datastream Information", "ResultType", "result_type"),
    ("Datastream Information", "Status", "status"),
    ("Datastream Information", "SampledMedium", "sampled_medium"),
    ("Datastream Information", "NoDataValue", "no_data_value"),
    ("Datastream Information", "IntendedTimeSpacing", "intended_time_spacing"),
    ("Datastream Information", "IntendedTimeSpacingUnit", "intended_time_spacing_unit"),
    ("Datastream Information", "AggregationStatistic", "aggregation_statistic"),
    ("Datastream Information", "TimeAggregationInterval", "time_aggregation_interval"),
    ("Datastream Information", "TimeAggregationIntervalUnit", "time_aggregation_interval_unit"),
    ("Method Information", "Name", "method_name"),
    ("Method Information", "Description", "method_description"),
    ("Method Information", "MethodCode", "method_code"),
    ("Method Information", "MethodType", "method_type"),
    ("Method Information", "MethodLink", "method_link"),
    ("Method Information", "SensorManufacturerName", "sensor_manufacturer_name"),
    ("Method Information", "SensorModelName", "sensor_model_name"),
    ("Method Information", "SensorModelLink", "sensor_model_link"),
    ("Observed Property Information", "Name", "variable_name"),
    ("Observed Property Information", "Definition", "variable_definition"),
    ("Observed Property Information", "Description", "variable_description"),
    ("Observed Property Information", "VariableType", "variable_type"),
    ("Observed Property Information", "VariableCode", "variable_code"),
    ("Unit Information", "Name", "unit_name"),
    ("Unit Information", "Symbol", "unit_symbol"),
    ("Unit Information", "Definition", "unit_definition"),
    ("Unit Information", "UnitType", "unit_type"),
    ("Processing Level Information", "Code", "processing_level_code"),
    ("Processing Level Information", "Definition", "processing_level_definition"),
    ("Processing Level Information", "Explanation", "processing_level_explanation"),
)
# Header patterns, texts that mean "nothing", numeric columns, data columns.
SECTION_PATTERN = r"^#\s+(.+?):\s*$"
ENTRY_PATTERN = r"^#\s+(\w[\w\s]*?):\s*(.+)$"
NOTHING = ("None", "N/A", "")
NUMERIC = (
    "latitude", "longitude", "elevation_m", "no_data_value", "intended_time_spacing",
    "time_aggregation_interval",
)
TIME, RESULT, QUALIFIER = "ResultTime", "Result", "ResultQualifiers"
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$|^(?i)[+-]?(nan|inf|infinity)$"
QUOTED_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their file and a position that rises within the file.

    Large files are split; the block start orders the splits and the running
    id orders the lines inside one.
    """
    return spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("position"),
    )


def number(text: Column) -> Column:
    """Numbers as a sensor logger writes them; anything else is null."""
    t = F.trim(text)
    return F.when(t.rlike(NUMBER), t.try_cast("double"))


def timestamp(text: Column) -> Column:
    """ISO timestamps; a zone is turned into UTC. Anything else is null."""
    t = F.trim(text)
    return F.when(t.rlike(ISO_TIME), F.try_to_timestamp(t)).cast("timestamp_ntz")


def header_entries(text: DataFrame) -> DataFrame:
    """Header lines with the section they belong to: ``file, position, section, key, value``.

    Only comment lines take part, so the window per file holds a header, not
    the data. A line ``# Name:`` that is no known section is left out without
    ending the current one.
    """
    known = sorted({s for s, _, _ in HEADER_KEYS})
    line = F.trim("line")
    head = text.where(F.col("line").startswith("#")).withColumn("line", line)
    is_section = F.col("line").rlike(SECTION_PATTERN)
    name = F.trim(F.regexp_extract("line", SECTION_PATTERN, 1))
    w = Window.partitionBy("file").orderBy("position")
    return (
        head.withColumn("section", F.last(F.when(is_section & name.isin(known), name), ignorenulls=True).over(w))
        .where(~is_section & F.col("line").rlike(ENTRY_PATTERN) & F.col("section").isNotNull())
        .select(
            "file",
            "position",
            "section",
            F.trim(F.regexp_extract("line", ENTRY_PATTERN, 1)).alias("key"),
            F.trim(F.regexp_extract("line", ENTRY_PATTERN, 2)).alias("value"),
        )
    )


def metadata(entries: DataFrame) -> DataFrame:
    """One row per file with a column per known header entry; the last mention counts."""
    keys = literal_rows(
        entries.sparkSession, "section string, key string, field string", list(HEADER_KEYS)
    )
    fields = [f for _, _, f in HEADER_KEYS]
    value = F.when(~F.col("value").isin(list(NOTHING)), F.col("value"))
    last = (
        entries.join(F.broadcast(keys), ["section", "key"])
        .groupBy("file", "field")
        .agg(F.max_by(value, "position").alias("value"))
    )
    # At most one entry per known field and file.
    described = last.groupBy("file").agg(
        F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("m")
    )
    return described.select(
        "file",
        *[(number(F.col("m")[f]) if f in NUMERIC else F.col("m")[f]).alias(f) for f in fields],
    )


def cells(line: Column) -> Column:
    """Cells of a CSV line; commas inside quotes do not separate."""
    return F.when(line.contains('"'), F.split(line, QUOTED_COMMA)).otherwise(F.split(line, ","))


def unquoted(cell: Column) -> Column:
    c = F.trim(cell)
    inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    quoted = c.startswith('"') & c.endswith('"') & (F.length(c) > 1)
    return F.when(quoted, F.trim(inner)).otherwise(c)


def records(text: DataFrame, trim_titles: bool = True) -> DataFrame:
    """Data lines as ``file, time_text, value_text, qualifier_text``, columns found by their header name.

    The first line of a file that is no comment and not blank names the columns.
    With ``trim_titles`` blanks around a title don't count; off, a padded title
    names no column, and its file gives no usable rows. A quoted cell must end
    on its line.
    """
    data = text.where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    # First the smallest place of each file by fixed-width numbers, then that one line.
    rows = data.groupBy("file", F.col("position.block").alias("block")).agg(F.min("position.row").alias("row"))
    first = per_key(rows.groupBy("file").agg(F.min(F.struct("block", "row")).alias("_first")))
    names = data.join(first, "file").where(F.col("position") == F.col("_first")).select("file", F.col("line").alias("names"))
    titles = F.transform(cells(F.col("names")), unquoted) if trim_titles else F.split("names", ",")
    places = per_key(
        names.select(
            "file", "names", *[F.array_position(titles, n).alias(f"_{n}") for n in (TIME, RESULT, QUALIFIER)]
        )
    )

    def cell(name):
        at = F.col(f"_{name}").cast("int")
        return unquoted(F.when(at > 0, F.try_element_at("_cells", at)))

    texts = F.struct(
        cell(TIME).alias("time_text"),
        cell(RESULT).alias("value_text"),
        cell(QUALIFIER).alias("qualifier_text"),
    )
    # The generator keeps later filters from splitting the line a second time.
    return (
        data.join(places, "file")
        .where(F.col("line") != F.col("names"))
        .withColumn("_cells", cells(F.col("line")))
        .select("file", F.inline(F.array(texts)))
    )


def observations(rows: DataFrame) -> DataFrame:
    """Rows with a usable time; a bad value stays as null, a blank qualifier is null."""
    rest = [c for c in rows.columns if c not in ("time_text", "value_text", "qualifier_text")]
    return rows.select(
        *rest,
        F.when(F.col("qualifier_text") != "", F.col("qualifier_text")).alias("qualifier_code"),
        timestamp(F.col("time_text")).alias("datetime_utc"),
        number(F.col("value_text")).alias("value"),
    ).where(F.col("datetime_utc").isNotNull())


def staging_rows(spark: SparkSession, path: str, apply_no_data: bool = False, trim_titles: bool = True) -> DataFrame:
    """Flat staging rows of all files of a path: every observation with its file's metadata.

    ``apply_no_data`` turns the declared no-data value into null; off, it stays
    a value.
    """
    text = lines(spark, path)
    described = observations(records(text, trim_titles)).join(per_key(metadata(header_entries(text))), "file", "left")
    if apply_no_data:
        described = described.withColumn(
            "value", F.when(~F.col("value").eqNullSafe(F.col("no_data_value")), F.col("value"))
        )
    return described.withColumn("qualifier_description", F.lit(None).cast("string")).withColumn(
        "source_file", F.element_at(F.split("file", "/"), -1)
    ).drop("file")


def rows_per_file(staged: DataFrame) -> DataFrame:
    """Observations per file, in file order, and over all files."""
    return (
        staged.rollup("source_file")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("source_file").asc_nulls_last())
    )

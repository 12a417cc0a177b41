"""Deterministic wide nested rows from a row number (S9) and planted errors.

Every value is an expression of the row number ``n``, so generation is a
plain projection: it partitions with its input and never materialises rows
on the driver.  Input is any DataFrame with a bigint ``n`` column
(``spark.range(N)`` for the benchmark; keys of a real table elsewhere).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Row count and planted-error block of the reference benchmark.
BENCH_ROWS = 1_000_000
BENCH_BATCH = 100_000
ERRORS_PER_KIND = 50_000
# Constant strings of the generated objects.
DEPARTMENT = "European Paintings"
PRIMARY_URL = "https://cdn.example.org/img.jpg"
DETAIL_URL = "https://cdn.example.org/det.jpg"


def _s(fmt: str, *cols: Column) -> Column:
    return F.format_string(fmt, *cols)


def generate_objects(ids: DataFrame, total: Column | int, n_col: str = "n") -> DataFrame:
    """20 columns (12 nested) per row, from the row number ``n``.

    The value rules (text patterns, moduli and offsets) are fixed values of the
    benchmark data definition, so the generated rows equal the studied ones.

    ``total`` is the row count used for the wrap-around of related objects."""
    n = F.col(n_col)
    tot = total if isinstance(total, Column) else F.lit(total)
    lit = F.lit
    return ids.select(
        _s("OBJ-%07d", n).alias("object_id"),
        _s("Artwork %d", n).alias("title"),
        (lit(1800) + n % 200).alias("date_made"),
        _s("Gift of donor %d", n).alias("credit_line"),
        lit(DEPARTMENT).alias("department"),
        _s("2024.%d.1", n).alias("accession_number"),
        (n % 3 != 0).alias("is_public_domain"),
        _s("Gallery %d", n % 50).alias("gallery_number"),
        F.array(
            F.struct(lit("height").alias("type"), (lit(50.0) + n % 100).cast("double").alias("value"), lit("cm").alias("unit")),
            F.struct(lit("width").alias("type"), (lit(30.0) + n % 80).cast("double").alias("value"), lit("cm").alias("unit")),
        ).alias("dimensions"),
        F.array(
            F.struct(lit("primary").alias("type"), lit(PRIMARY_URL).alias("url"), lit("Front").alias("caption")),
            F.struct(lit("detail").alias("type"), lit(DETAIL_URL).alias("url"), lit("Detail").alias("caption")),
        ).alias("media"),
        F.array(
            F.struct(lit("Painting").alias("type_label"), lit("Oil on canvas").alias("term_label")),
            F.struct(lit("Subject").alias("type_label"), lit("Landscape").alias("term_label")),
        ).alias("classifications"),
        F.array(
            F.struct(_s("Artist %d", n).alias("name"), lit("artist").alias("role"),
                     (lit(1750) + n % 150).alias("birth_year"), lit("French").alias("nationality")),
            F.struct(_s("Maker %d", n).alias("name"), lit("frame_maker").alias("role"),
                     (lit(1760) + n % 140).alias("birth_year"), lit("Italian").alias("nationality")),
        ).alias("constituents"),
        F.array(F.struct(_s("Exhibition %d", n % 20).alias("title"), (lit(1990) + n % 30).alias("year"),
                         _s("Museum %d", n % 10).alias("venue"))).alias("exhibitions"),
        F.array(
            F.struct(_s("Collector %d", n % 100).alias("owner"), (lit(1900) + n % 100).alias("acquired"),
                     lit("purchase").alias("method")),
            F.struct(_s("Dealer %d", n % 50).alias("owner"), (lit(1850) + n % 120).alias("acquired"),
                     lit("inheritance").alias("method")),
        ).alias("provenance"),
        F.array(F.struct(_s("Author %d", n % 200).alias("author"), _s("Book %d", n % 500).alias("title"),
                         (lit(1950) + n % 70).alias("year"),
                         _s("%d-%d", n % 300, n % 300 + 5).alias("pages"))).alias("bibliography"),
        F.array(F.struct(_s("Signed %d", n).alias("text"), lit("lower right").alias("location"),
                         lit("signature").alias("type"))).alias("inscriptions"),
        F.array(F.struct(_s("20%02d-01-15", n % 24).alias("date"), lit("cleaning").alias("treatment"),
                         _s("Conservator %d", n % 30).alias("conservator"))).alias("conservation"),
        F.array(F.struct(_s("OBJ-%07d", (n + 1) % tot).alias("object_id"),
                         lit("companion").alias("relationship"))).alias("related_objects"),
        F.array(
            F.struct(lit("fr").alias("language"), _s("Oeuvre %d", n).alias("title")),
            F.struct(lit("de").alias("language"), _s("Werk %d", n).alias("title")),
        ).alias("alt_titles"),
        F.array(F.struct(_s("Gallery %d", n % 50).alias("gallery"), (n % 4).alias("floor"),
                         lit("East").alias("wing"))).alias("locations"),
        n.alias(n_col),
    )


def inject_errors(df: DataFrame, per_kind: Column | int = ERRORS_PER_KIND, n_col: str = "n") -> DataFrame:
    """Four disjoint blocks of ``per_kind`` rows each get one planted defect.

    ``[0, k)`` one dimension of 0.5 cm; ``[k, 2k)`` no constituents;
    ``[2k, 3k)`` no media; ``[3k, 4k)`` no provenance."""
    n = F.col(n_col)
    k = per_kind if isinstance(per_kind, Column) else F.lit(per_kind)
    dims_t = df.schema["dimensions"].dataType

    def block(i: int) -> Column:
        return (n >= k * i) & (n < k * (i + 1))

    def empty(col: str) -> Column:
        return F.array().cast(df.schema[col].dataType)

    bad_dim = F.array(F.struct(F.lit("height").alias("type"), F.lit(0.5).cast("double").alias("value"),
                               F.lit("cm").alias("unit"))).cast(dims_t)
    return df.withColumns({
        "dimensions": F.when(block(0), bad_dim).otherwise(F.col("dimensions")),
        "constituents": F.when(block(1), empty("constituents")).otherwise(F.col("constituents")),
        "media": F.when(block(2), empty("media")).otherwise(F.col("media")),
        "provenance": F.when(block(3), empty("provenance")).otherwise(F.col("provenance")),
    })

"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelmart import schemas as S


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """x / y as DOUBLE; a zero or NULL denominator gives NULL, never an error."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def r6(c: Column) -> Column:
    """Round to 6 decimals so results compare across engines."""
    return F.round(c, 6)


def asset_identity(client_id: Column, content_sha256: Column) -> Column:
    """Tenant-scoped identity sha256(client ':' content hash); NULL in, NULL out."""
    return F.sha2(F.concat(client_id, F.lit(":"), content_sha256), 256)


def padded_sequence(seq: Column) -> Column:
    """Zero-pad a sequence to 3 digits without truncating 1000 and above."""
    s = seq.cast("string")
    return F.when(F.length(s) < 3, F.lpad(s, 3, "0")).otherwise(s)


def chunk_id(asset_id: Column, seq: Column) -> Column:
    return F.concat(asset_id, F.lit("_"), padded_sequence(seq))


def extension(name: Column) -> Column:
    ext = F.regexp_extract(name, r"(\.[^.]+)$", 1)
    return F.coalesce(F.nullif(ext, F.lit("")), F.lit(S.DEFAULT_EXTENSION))


def mime_type(ext: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in S.MIME_BY_EXT.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, F.lower(ext)), F.lit("video/mp4"))


def asset_type_from_folder(folder: Column) -> Column:
    return F.when(F.lower(folder).rlike(S.EDITED_FOLDER_PATTERN), F.lit("EDITED")) \
        .otherwise(F.lit("RAW"))


def landing_key(client_id: Column, asset_id: Column, ext: Column) -> Column:
    with_client = F.concat(F.lit("landing/"), client_id, F.lit("/video/"), asset_id, ext)
    dev = F.concat(F.lit("landing/video/"), asset_id, ext)
    return F.when(F.coalesce(client_id, F.lit("")) == "", dev).otherwise(with_client)


def bronze_key(client_id: Column, asset_id: Column) -> Column:
    return F.when(F.coalesce(client_id, F.lit("")) == "",
                  F.concat(F.lit("bronze/asset_raw/"), asset_id, F.lit(".parquet"))) \
        .otherwise(F.concat(F.lit("bronze/"), client_id, F.lit("/asset_raw/"), asset_id,
                            F.lit(".parquet")))


def source_uri(workspace: str, lakehouse: str, key: Column) -> Column:
    return F.concat(F.lit(f"abfss://{workspace}@{S.URI_HOST}/{lakehouse}.Lakehouse/Files/"), key)


def whole_seconds_from_ms(ms: Column) -> Column:
    """Duration ms -> floor seconds; missing or zero stays empty (NULL)."""
    return F.when(ms > 0, F.floor(ms / F.lit(1000)).cast("int"))


def like_literal(text: str) -> str:
    """Escape LIKE wildcards so user text matches literally."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def contains_ci(col: Column, text: str) -> Column:
    """Case-insensitive substring test with % and _ taken literally."""
    return F.ilike(col, F.lit("%" + like_literal(text) + "%"), F.lit("\\"))


def to_seconds(label: Column) -> Column:
    """'ss', 'mm:ss' or 'hh:mm:ss' (or a plain number) -> seconds as DOUBLE."""
    parts = F.split(label, ":")
    n = F.size(parts)
    p = lambda i: F.element_at(parts, i).try_cast("double")
    return (F.when(n == 1, p(1))
            .when(n == 2, p(1) * 60 + p(2))
            .when(n == 3, p(1) * 3600 + p(2) * 60 + p(3)))


def two_sided_normal_p(z: Column) -> Column:
    """2 * (1 - Phi(|z|)) with the Abramowitz-Stegun 26.2.17 tail polynomial.

    Spark has no erf; the oracle uses the same polynomial, so both agree to
    the last printed digit.
    """
    # FIXED VALUES: coefficients of the published polynomial (A&S 26.2.17).
    p_, b1, b2, b3, b4, b5 = 0.2316419, 0.319381530, -0.356563782, 1.781477937, \
        -1.821255978, 1.330274429
    az = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(p_) * az)
    poly = t * (F.lit(b1) + t * (F.lit(b2) + t * (F.lit(b3) + t * (F.lit(b4) + t * F.lit(b5)))))
    pdf = F.exp(F.lit(-0.5) * az * az) * F.lit(0.3989422804014327)
    return F.least(F.lit(1.0), F.lit(2.0) * pdf * poly)


def literal_table(spark, rows: list[tuple], schema: str):
    """A small literal table built in the JVM (no Python RDD, no Python
    workers): ``inline`` over an array of literal structs. ``schema`` is
    'name TYPE, ...'."""
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))

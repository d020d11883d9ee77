"""Payload expressions: magic bytes, encodings, identifiers. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: magic numbers of the known image formats (hex of the first bytes)
MAGIC = (("FFD8FF", ".jpg"), ("89504E470D0A1A0A", ".png"), ("474946", ".gif"), ("424D", ".bmp"), ("49492A00", ".tiff"), ("4D4D002A", ".tiff"))
EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".tiff")


def _starts(data: Column, hexed: str) -> Column:
    return F.startswith(data, F.unhex(F.lit(hexed)))


def is_webp(data: Column) -> Column:
    return _starts(data, "52494646") & (F.substring(data, 9, 4) == F.encode(F.lit("WEBP"), "UTF-8"))


def image_ext(data: Column) -> Column:
    """The extension that the magic bytes tell; ``.jpg`` if none does."""
    out = F.when(is_webp(data), ".webp")
    for magic, ext in MAGIC:
        if ext != ".gif":
            out = out.when(_starts(data, magic), ext)
    return out.otherwise(".jpg")


def has_image_magic(data: Column) -> Column:
    """True where the first bytes are those of a known format."""
    out = is_webp(data)
    for magic, _ in MAGIC:
        out = out | _starts(data, magic)
    return F.coalesce(out, F.lit(False))


def file_ext(path: Column) -> Column:
    """Lower-case extension of a path's last part, with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(path, r"[^/\\](\.[^./\\]*)$", 1))


def stem(path: Column) -> Column:
    """The last part of a path without its extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")


def is_image_file(path: Column, data: Column) -> Column:
    return file_ext(path).isin(*EXTENSIONS) | has_image_magic(data)


def _hex_payload(text: Column) -> Column:
    return F.when(text.rlike(r"^(0[xX]|\\x)([0-9A-Fa-f]{2})*$"), F.unhex(F.substring(text, 3, 2**30)))


def _base64_payload(text: Column) -> Column:
    """URL-safe letters are mapped first: the decoder would otherwise cut the value short."""
    return F.try_to_binary(F.translate(F.regexp_replace(text, r"\s+", ""), "-_", "+/"), F.lit("base64"))


def decode_text(value: Column) -> Column:
    """The bytes of a text cell: 0x or \\x hex, data-URL, plain base64 of an image, else its UTF-8 bytes."""
    text = F.trim(value)
    dense = F.regexp_replace(text, r"\s+", "")
    plain = F.when((F.length(dense) > 32) & dense.rlike("^[A-Za-z0-9+/=_-]+$"), _base64_payload(dense))
    url = F.when(text.startswith("data:image/") & F.contains(text, F.lit(";base64,")), _base64_payload(F.substring_index(text, ";base64,", -1)))
    return F.coalesce(_hex_payload(text), url, F.when(has_image_magic(plain), plain), F.encode(text, "UTF-8"))


def decode_payload(df, value: str, files=None):  # noqa: ANN001, ANN201
    """Adds ``bytes``, ``path`` and ``ext`` for a text or binary column.

    ``files`` (path, content) resolves cells that name an existing file: a left join.
    """
    if df.schema[value].dataType.simpleString() == "binary":
        return df.withColumn("bytes", F.col(value)).withColumn("path", F.lit(None).cast("string")).withColumn("ext", image_ext(F.col(value)))
    out = df.withColumn("bytes", decode_text(F.col(value))).withColumn("path", F.lit(None).cast("string"))
    if files is not None:
        known = files.select(F.col("path").alias("_file")).distinct()
        out = out.join(known, F.trim(F.col(value)) == F.col("_file"), "left").withColumn("path", F.col("_file")).withColumn("bytes", F.when(F.col("_file").isNull(), F.col("bytes"))).drop("_file")
    suffix = F.when(file_ext(F.col("path")) == "", ".jpg").otherwise(file_ext(F.col("path")))
    return out.withColumn("ext", F.when(F.col("path").isNotNull(), suffix).otherwise(F.coalesce(image_ext(F.col("bytes")), F.lit(".jpg"))))


def safe_id(value: Column) -> Column:
    """An identifier that file systems take."""
    out = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(value.cast("string"), F.lit(""))), r'[\\/*?:"<>|]', "_"), r"\s+", "_")
    return F.when(out == "", "sin_id").otherwise(out)


def delivery_id(given: Column, source: Column) -> Column:
    return F.coalesce(F.when(given != "", given), stem(source))


def delivery_name(rank: Column, ident: Column, ext: Column) -> Column:
    return F.format_string("%06d_%s_crop%s", rank.cast("int"), ident, F.when(ext == "", ".jpg").otherwise(F.lower(ext)))


def duration(seconds: Column) -> Column:
    """``MMm SSs``, or with hours ``HHh MMm SSs``, of whole seconds, halves to even."""
    s = F.greatest(F.bround(seconds), F.lit(0)).cast("long")
    h, m, r = F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int"), (s % 60).cast("int")
    return F.when(h > 0, F.format_string("%02dh %02dm %02ds", h, m, r)).otherwise(F.format_string("%02dm %02ds", m, r))


def split_fragments(cells: Column, at: int) -> Column:
    """How many cells after cell ``at`` belong to its data-URL, which was split at its commas."""
    after = F.slice(cells, at + 2, F.greatest(F.size(cells) - at - 1, F.lit(0)))
    stop = F.array_position(F.transform(after, lambda x: F.coalesce(x.rlike("^[A-Za-z0-9+/=_-]{16,}$"), F.lit(False))), False)
    n = F.when(stop > 0, stop - 1).otherwise(F.size(after))
    return F.when(F.get(cells, F.lit(at)).rlike("^data:image/.*;base64$"), n).otherwise(0).cast("int")


def repair_split_cells(cells: Column, at: int) -> Column:
    """Rejoins a data-URL that was split at its commas: cell ``at`` and the base64-like cells after it."""
    return F.when(F.get(cells, F.lit(at)).isNotNull(), F.array_join(F.slice(cells, F.lit(at + 1), split_fragments(cells, at) + 1), ","))

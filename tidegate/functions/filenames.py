"""File and endpoint names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used.

    Without it an expression that is used several times, above all in a filter,
    is copied to every place.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def basename(path: Column) -> Column:
    """Last component of a slash-separated path; trailing ``/`` and ``/.`` do not count."""
    return F.regexp_extract(path, r"((?!\.(?:/|$))[^/]++)(?:/++\.?)*$", 1)


def scanned_name(encoded: Column | None = None) -> Column:
    """Name of the file a scanned row comes from.

    Spark reports names and paths percent-encoded, but for ``+``, which stands
    for itself.
    """
    encoded = F.col("_metadata.file_name") if encoded is None else encoded
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def stem(name: Column) -> Column:
    """File name without its last suffix; a leading or closing dot is no suffix."""
    return F.regexp_replace(basename(name), r"(?<=.)\.[^.]+$", "")


def sidecar_name(name: Column) -> Column:
    return F.concat(stem(name), F.lit(".meta.json"))


def endpoint_folder(endpoint: Column) -> Column:
    return F.replace(endpoint, F.lit("/"), F.lit("_"))


def safe_filename(name: Column, now: Column | None = None) -> Column:
    """A name that is safe to store: no folders, no reserved characters, not hidden.

    ``now`` (epoch seconds) names files whose cleaned name would be unusable.
    """
    now = F.unix_timestamp() if now is None else now
    last = F.when(name.contains("\\"), F.substring_index(name, "\\", -1)).otherwise(basename(name))
    clean = F.regexp_replace(last, r'[<>:"/|?*]', "_")
    unnamed = F.concat(F.lit("unnamed_"), F.floor(now).cast("string"), F.lit(".csv"))
    usable = bind(clean, lambda c: F.when((c != "") & ~c.startswith("."), c))
    return F.when(F.coalesce(name, F.lit("")) == "", F.lit("unnamed_file.csv")).otherwise(
        F.coalesce(usable, unnamed)
    )


def filename_of_response(disposition: Column, endpoint: Column, day: Column, fmt: str = "csv") -> Column:
    """File name offered by a Content-Disposition header, or one built from the request."""
    offered = F.regexp_replace(F.regexp_substr(disposition, F.lit('filename="?[^"]+')), '^filename="?', "")
    built = F.concat(
        endpoint_folder(endpoint), F.lit("_"), F.date_format(day, "yyyyMMdd"), F.lit(f".{fmt}")
    )
    return F.coalesce(offered, built)


def date_text_of_filename(name: Column) -> Column:
    """``yyyy-MM-dd`` text for the first ``MM-DD-YYYY`` in a name, not validated, or null."""
    found = F.regexp_substr(name, F.lit(r"\d{2}-\d{2}-\d{4}"))
    return F.regexp_replace(found, r"(\d{2})-(\d{2})-(\d{4})", "$3-$1-$2")

"""Status of asynchronous export documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOWNLOAD = "struct<public:string,href:string,skipped:boolean>"
# The document fields that decide the status.
STATUS_SCHEMA = (
    "id string, filter_id string, published boolean, "
    "events array<struct<type:string,timestamp:string>>, "
    f"downloads struct<csv:{_DOWNLOAD},csvw:{_DOWNLOAD}>"
)


def parse_status(document: Column) -> Column:
    """Parse a status document; unknown fields are ignored."""
    return F.from_json(document, STATUS_SCHEMA)


def download_ready(status: Column, kind: str) -> Column:
    """A download has a non-empty link and is not skipped."""
    item = status["downloads"][kind]
    linked = (F.coalesce(item["public"], F.lit("")) != "") | (
        F.coalesce(item["href"], F.lit("")) != ""
    )
    return linked & ~F.coalesce(item["skipped"], F.lit(False))


def reported_error(status: Column) -> Column:
    """Any event of type ``error``."""
    return F.coalesce(
        F.exists(status["events"], lambda e: F.coalesce(e["type"] == "error", F.lit(False))),
        F.lit(False),
    )


def job_status(status: Column) -> Column:
    """``ready`` when data and metadata are both there, else ``error``, else ``pending``."""
    return (
        F.when(download_ready(status, "csv") & download_ready(status, "csvw"), "ready")
        .when(reported_error(status), "error")
        .otherwise("pending")
    )

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

_FIELDS = ("server_ip", "org_id", "domain", "date", "id")


def parse_location(location: Column | str = "archive_location") -> Column:
    """Split ``serverIP:orgID:domain:date:id`` into a struct.

    Valid iff the string splits into exactly five parts on ':' (empty parts are
    allowed, nothing is trimmed). NULL and '' are invalid. Invalid rows get
    ``valid = false`` and NULL fields.
    """
    loc = F.col(location) if isinstance(location, str) else location
    parts = F.split(loc, C.LOCATION_SEPARATOR, -1)
    valid = F.coalesce(F.size(parts) == C.LOCATION_PARTS, F.lit(False))
    fields = [F.when(valid, F.get(parts, i)).alias(name) for i, name in enumerate(_FIELDS)]
    return F.struct(valid.alias("valid"), *fields)


def build_url(parsed: Column | str = "loc") -> Column:
    """``http://{ip}:8686/archive/read/{org}/{domain}/{date}/{id}``; no escaping. NULL if invalid."""
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    return F.concat(
        F.lit(C.URL_PREFIX), p["server_ip"], F.lit(C.URL_PORT_AND_PATH),
        p["org_id"], F.lit("/"), p["domain"], F.lit("/"), p["date"], F.lit("/"), p["id"],
    )


def entry_name(archive_id: Column | str = "archive_id") -> Column:
    """Name of the entry inside an archive: ``{archive_id}.eml``."""
    a = F.col(archive_id) if isinstance(archive_id, str) else archive_id
    return F.concat(a, F.lit(C.ENTRY_SUFFIX))

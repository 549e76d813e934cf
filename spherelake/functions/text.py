"""String, date, hash and attribute helpers of the pipelines."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The date token of a file name (fixed pattern).
DATE_TOKEN = r"_(\d{6}|\d{8})_"


def sanitise(name: Column) -> Column:
    """Runs of characters outside [A-Za-z0-9._-] become one underscore; outer ones and outer dots go; what is empty then is "source"."""
    bare = F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(bare == "", "source").otherwise(bare)


def date_token(name: Column) -> Column:
    """The six- or eight-digit token between underscores, or NULL."""
    got = F.regexp_extract(name, DATE_TOKEN, 1)
    return F.when(got != "", got)


def period(token: Column) -> tuple[Column, Column]:
    """Begin and end of the month or day that a token names; other tokens give NULL."""
    six, eight = F.length(token) == 6, F.length(token) == 8
    month = F.to_date(F.concat(token, F.lit("01")), "yyyyMMdd")
    day = F.to_date(token, "yyyyMMdd")
    begin = F.when(six, month).when(eight, day)
    end = F.when(six, F.add_months(month, 1).cast("date")).when(eight, F.date_add(day, 1))
    return utc_midnight(begin), utc_midnight(end)


def utc_midnight(day: Column) -> Column:
    """The begin of a day in UTC, whatever the session's time zone."""
    return F.timestamp_micros(F.unix_date(day).cast("long") * 86_400_000_000)


def keep_period(begin: Column, end: Column, start: Column, stop: Column, known: Column | None = None) -> Column:
    """Keep a period that meets the request and isn't wholly known already; one without a token stays."""
    meets = ~((end <= start) | (begin > stop))
    fresh = F.lit(True) if known is None else known.isNull() | (end > known)
    return begin.isNull() | (meets & fresh)


def parse_time(text: Column) -> Column:
    """ISO text to UTC; "now" is the query's time; a text without a zone is UTC; else NULL."""
    stripped = F.regexp_replace(F.trim(text), "[Zz]$", "+00:00")
    whole = F.when(stripped.rlike("^[0-9-]+$"), F.concat(stripped, F.lit("T00:00:00+00:00")))
    whole = whole.when(stripped.rlike(r"[T ].*[+-]\d{2}(:?\d{2})?$"), stripped).otherwise(F.concat(stripped, F.lit("+00:00")))
    return F.when(F.lower(F.trim(text)) == "now", F.current_timestamp()).otherwise(F.try_to_timestamp(whole))


def iso_utc(t: Column) -> Column:
    """Whole seconds as yyyy-MM-ddTHH:mm:ssZ in UTC, whatever the session's time zone."""
    seconds = F.floor(F.unix_micros(t.cast("timestamp")) / 1_000_000)
    moved = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.floor(seconds / 86400).cast("int"), F.lit(0), F.lit(0), F.pmod(seconds, F.lit(86400)).cast("decimal(18,6)"))
    # A time without a zone, or a date, is UTC already.
    wall = F.when(F.typeof(t).isin("timestamp_ntz", "date"), t.cast("timestamp_ntz")).otherwise(moved)
    return F.concat(F.translate(F.substring(wall.cast("string"), 1, 19), " ", "T"), F.lit("Z"))


def valid_time(time: Column, step_seconds: Column) -> Column:
    """A forecast's time plus its step."""
    return F.timestamp_micros(F.unix_micros(time.cast("timestamp")) + step_seconds.cast("long") * 1_000_000)


def add_cell_method(methods: Column) -> Column:
    """Append "cell: mean" unless some cell method is there."""
    old = F.coalesce(methods, F.lit(""))
    return F.when(old.contains("cell:"), old).when(F.trim(old) == "", F.lit("cell: mean")).otherwise(F.concat(F.trim(old), F.lit(" cell: mean")))


def store_name(root: str, level: int) -> str:
    return f"{root.rstrip('/')}/level_{level}"


def store_names(root: Column, level: Column) -> Column:
    return F.format_string("%s/level_%d", F.regexp_replace(root, "/+$", ""), level)


def parse_dims(value: Any) -> tuple[str, ...] | None:
    """Dimension names from a JSON list or string, a comma list, or a sequence of strings; else None."""
    listed = _listed(value.strip()) if isinstance(value, str) else value
    named = isinstance(listed, (list, tuple)) and all(isinstance(x, str) for x in listed)
    return tuple(listed) if named else None


def _listed(text: str) -> Any:
    """What a text stands for: its JSON, a JSON string being a list of one, else its parts between commas; None if empty."""
    if text[:1] in ("", "[", '"', "{"):
        try:
            got = json.loads(text or "null")
            return [got] if isinstance(got, str) else got
        except json.JSONDecodeError:
            pass
    elif text in ("null", "true", "false") or text.replace(".", "", 1).isdigit():
        return None
    return [part.strip() for part in text.split(",") if part.strip()]


def dims_array(value: Column) -> Column:
    """The same as an expression: JSON list, else the parts between commas; NULL for an empty text."""
    text = F.trim(value)
    as_list = F.from_json(text, "array<string>")
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    quoted = F.regexp_extract(text, r'^"(.*)"$', 1)
    return F.when(F.coalesce(text, F.lit("")) == "", None).when(text.startswith("["), as_list).when(text.startswith('"'), F.array(quoted)).otherwise(parts)


def digest(*parts: Any, size: int = 16) -> str:
    """SHA-256 of parts in order, each with its length, as so many hex digits."""
    h = hashlib.sha256()
    for p in parts:
        raw = p if isinstance(p, bytes) else json.dumps(p, sort_keys=True, default=str).encode()
        h.update(len(raw).to_bytes(8, "big") + raw)
    return h.hexdigest()[:size]


def pair_hash(source: str, target: str, size: int = 16) -> str:
    """BLAKE2b of a source's and a target's hash."""
    return hashlib.blake2b(f"{source}\0{target}".encode(), digest_size=size // 2).hexdigest()


def s3_options(endpoint: str, secrets: str, **more: str) -> dict[str, str]:
    """Options for an object store from a JSON text with accessKey and secretKey."""
    got = json.loads(secrets)
    if not isinstance(got, dict):
        raise ValueError("the secrets must be a JSON object")
    return {"endpoint_url": endpoint, "key": got["accessKey"], "secret": got["secretKey"], **more}

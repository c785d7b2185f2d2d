"""Raw log lines to typed session records.

Three line formats are read: JSON (anywhere in the line), RFC 5424 text with ``KEY="VALUE"`` pairs, and router
connection-tracking text. Each field is a priority chain over the formats, so a mixed line may take its fields
from several of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowledger import schema
from flowledger.functions.ip import canonical_ip
from flowledger.functions.text import counter, extract, not_empty, outer_object, unsigned_or_zero
from flowledger.functions.timestamps import best_effort_timestamp

UINT16 = 65535
UINT32 = 4294967295

# For each field, the patterns after the JSON key, in order of priority: key/value pair, then
# connection-tracking text.
# The look-behinds only stop a search from restarting inside a word or number it has already rejected; behind the
# first digit instead of in front of it they are not tried at every character.
PATTERNS = {
    "timestamp": (r"time='([^']+)'", r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"),
    "collector_id": (r"^\S+\s+\S+\s+(\S+)", r"(?<!\S)(\S+:\s+\S+)\s+forward:"),
    "subscriber_id": (r'USERNAME="([^"]+)"', r"in:<([^>]+)>"),
    "source_ip": (r'ISADDR="([^"]+)"', r"(\d(?<!\d\d)\d*\.\d+\.\d+\.\d+):\d+\s*->"),
    "destination_ip": (r'IDADDR="([^"]+)"', r"->\s*(\d+\.\d+\.\d+\.\d+):\d+"),
    "source_port": (r'ISPORT="([^"]+)"', r"\d(?<!\w\d)\d*\.\d+\.\d+\.\d+:(\d+)\s*->"),
    "destination_port": (r'IDPORT="([^"]+)"', r"->\s*\d+\.\d+\.\d+\.\d+:(\d+)"),
    "protocol": (r'PROTO="([^"]+)"', r"proto\s+(\w+)"),
    "rat_type": (r'IATYP="([^"]+)"',),
}
# Texts without which no pattern holding them can match; looked for once per line.
MARKS = {"has_pairs": '="', "has_arrow": "->"}
JSON_NAMES = {"timestamp": "ISODATE"}
DEFAULT_SERVICE = "nat_session"
UNSET_IP = "::"
UNSET_TEXT = ("imsi", "imei", "msisdn", "cell_id", "cause_code", "charging_id")
# Protocol numbers and their names.
PROTOCOL_NAMES = {"6": "tcp", "17": "udp", "1": "icmp", "47": "gre"}

# A JSON value counts only when the whole text is one well-formed object.
_STRICT_JSON = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
STATUS_MODES = ("substring", "msgid")


def _with_json(lines: DataFrame) -> DataFrame:
    """Adds ``json`` (struct of texts, NULL without a well-formed object) and the marks found in the line."""
    raw = F.col("raw_message")
    # Read as a one-element array: leftovers behind the object make the array malformed or longer.
    listed = F.concat(F.lit("["), outer_object(raw), F.lit("]"))
    objects = F.from_json(F.col("listed"), T.ArrayType(schema.JSON_OBJECT), _STRICT_JSON)
    marks = [F.contains(raw, F.lit(text)).alias(mark) for mark, text in MARKS.items()]
    parsed = lines.select("*", *marks, listed.alias("listed")).select(
        *lines.columns, *MARKS, F.when(F.col("listed").isNotNull(), objects).alias("objects")
    )
    # A generator keeps later filters above it; pushed below, they would parse the JSON a second time.
    one = F.when(F.size("objects") == 1, F.transform("objects", lambda o: F.struct(o.alias("json"))))
    return parsed.select(*lines.columns, *MARKS, F.inline_outer(one))


def _json(key: str) -> Column:
    return not_empty(F.col(f"json.{key}"))


def _chain(field: str) -> Column:
    """First non-empty value of a field over the formats, NULL if there is none."""
    found = []
    for pattern in PATTERNS[field]:
        value = extract(F.col("raw_message"), pattern)
        for mark, text in MARKS.items():
            if text in pattern:
                value = F.when(F.col(mark), value)
        found.append(value)
    return F.coalesce(_json(JSON_NAMES.get(field, field)), *found)


def _status(mode: str) -> Column:
    """JSON status, else by the message kind.

    ``substring`` looks for the kind anywhere in the line, where it is also part of some key names, so lines with
    such keys are always ``active``. ``msgid`` looks for it as a word of its own.
    """
    raw = F.col("raw_message")
    if mode == "substring":
        started, ended = F.contains(raw, F.lit("SADD")), F.contains(raw, F.lit("SDEL"))
    elif mode == "msgid":
        started, ended = raw.rlike(r"\bSADD\b"), raw.rlike(r"\bSDEL\b")
    else:
        raise ValueError(f"status_mode must be one of {STATUS_MODES}, not {mode!r}")
    by_kind = F.when(started, "active").when(ended, "success").otherwise("")
    return F.coalesce(_json("status"), by_kind)


def _checked(lines: DataFrame) -> DataFrame:
    """Lines of a subscriber with time and both addresses; ``reason`` says why an address could not be read."""
    line = ("raw_message", "ingest_ts", "json", *MARKS)
    texts = _with_json(lines).select(
        *line,
        _chain("subscriber_id").alias("subscriber_id"),
        _chain("timestamp").alias("time_text"),
        F.coalesce(_chain("source_ip"), F.lit(UNSET_IP)).alias("source_text"),
        F.coalesce(_chain("destination_ip"), F.lit(UNSET_IP)).alias("destination_text"),
    )
    values = texts.select(
        *line,
        "subscriber_id",
        "source_text",
        "destination_text",
        F.when(F.col("time_text").isNull(), F.date_trunc("second", "ingest_ts"))
        .otherwise(best_effort_timestamp(F.col("time_text")))
        .alias("timestamp"),
        canonical_ip(F.col("source_text")).alias("source_ip"),
        canonical_ip(F.col("destination_text")).alias("destination_ip"),
    )
    reason = F.when(F.col("source_ip").isNull(), F.concat(F.lit("source_ip: "), "source_text")).when(
        F.col("destination_ip").isNull(), F.concat(F.lit("destination_ip: "), "destination_text")
    )
    checked = F.struct("subscriber_id", "timestamp", "source_ip", "destination_ip", reason.alias("reason"))
    # Same reason as in _with_json: report filters on these fields must not compute them a second time.
    return values.select(*line, F.inline(F.array(checked))).filter(F.col("subscriber_id").isNotNull())


def _with_raw_lines(lines: DataFrame, strip_header: str | None) -> DataFrame:
    raw = F.col("raw_message")
    if strip_header:
        raw = F.regexp_replace(raw, strip_header, "")
    ingested = F.col("ingest_ts") if "ingest_ts" in lines.columns else F.current_timestamp()
    return lines.select(raw.alias("raw_message"), ingested.alias("ingest_ts"))


def parse_lines(lines: DataFrame, status_mode: str = "substring", strip_header: str | None = None) -> DataFrame:
    """All lines that name a subscriber: record columns, ``ingest_ts``, and ``reason`` where a line is no record.

    ``ingest_ts`` stands in for the missing time of a line and is the load time, so a replay gives equal rows.
    """
    json = lambda key: F.col(f"json.{key}")
    number = lambda field: counter(json(field))
    counted = _checked(_with_raw_lines(lines, strip_header)).select(
        "*",
        _chain("source_port").alias("source_port_text"),
        _chain("destination_port").alias("destination_port_text"),
        number("bytes_in").alias("bytes_in"),
        number("bytes_out").alias("bytes_out"),
    )
    columns = {
        "collector_id": F.coalesce(_chain("collector_id"), F.lit("")),
        "subscriber_ip": F.lit(UNSET_IP),
        **{name: F.lit("") for name in UNSET_TEXT},
        "source_port": unsigned_or_zero(F.col("source_port_text"), UINT16).cast("int"),
        "destination_port": unsigned_or_zero(F.col("destination_port_text"), UINT16).cast("int"),
        "protocol": F.lower(F.coalesce(_chain("protocol"), F.lit(""))),
        "service_type": F.coalesce(_json("service_type"), F.lit(DEFAULT_SERVICE)),
        "apn": F.coalesce(json("apn"), F.lit("")),
        "rat_type": F.coalesce(_chain("rat_type"), F.lit("")),
        "bytes_total": F.try_add("bytes_in", "bytes_out"),
        "packets_in": number("packets_in"),
        "packets_out": number("packets_out"),
        "duration_seconds": unsigned_or_zero(json("duration_seconds"), UINT32),
        "status": _status(status_mode),
        "parsed_at": F.date_trunc("second", "ingest_ts"),
    }
    return counted.select(
        *[columns[name].alias(name) if name in columns else F.col(name) for name in schema.RECORDS.names],
        "ingest_ts",
        "reason",
    )


def records_in(parsed: DataFrame) -> DataFrame:
    """The session records among parsed lines."""
    return parsed.filter(F.col("reason").isNull()).select(*schema.RECORDS.names)


def quarantine_in(parsed: DataFrame) -> DataFrame:
    """The lines among parsed lines that could not become records, with the reason."""
    return parsed.filter(F.col("reason").isNotNull()).select("raw_message", "ingest_ts", "reason")


def parse_records(lines: DataFrame, status_mode: str = "substring", strip_header: str | None = None) -> DataFrame:
    """Typed session records of raw lines (``raw_message``, ``ingest_ts``).

    Lines without a subscriber are no records. Lines with an unreadable address are left to :func:`quarantine`.
    """
    return records_in(parse_lines(lines, status_mode, strip_header))


def quarantine(lines: DataFrame, strip_header: str | None = None) -> DataFrame:
    """Lines that name a subscriber but cannot become records, with the reason."""
    return quarantine_in(parse_lines(lines, strip_header=strip_header))


def with_protocol_name(records: DataFrame) -> DataFrame:
    """Adds ``protocol_name``: known protocol numbers by name, everything else as it is."""
    name = F.col("protocol")
    for number, known in PROTOCOL_NAMES.items():
        name = F.when(F.col("protocol") == number, known).otherwise(name)
    return records.withColumn("protocol_name", name)

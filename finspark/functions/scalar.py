"""Scalar column functions (F1-F15): all JVM-side expressions, no UDFs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Marker written for NULL parts of a null-aware record digest.
NULL_TOKEN = "\\N"
HASH_SEP = "\u001f"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: _dt.datetime | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so the wall-clock value does not
    depend on the Python process or session time zone."""
    if not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def safe_div(num, den) -> Column:
    """num / den with an undefined ratio (den = 0 or NULL) as NULL, never inf."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """NaN as NULL in float and double columns (of ``columns``, if given): missing numbers have
    one form (§1.3).  An expression, no pass over the data."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and (columns is None or f.name in columns):
            c = F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name)
        cols.append(c)
    return df.select(*cols)


# Strptime directive -> Spark datetime pattern.  Day, month,
# hour, minute and second use the one-letter forms so that values without a
# leading zero (accepted by strptime) also parse.
STRPTIME_TO_SPARK = {
    "%Y": "yyyy", "%y": "yy", "%m": "M", "%d": "d", "%H": "H", "%I": "h",
    "%M": "m", "%S": "s", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM",
    "%j": "D", "%z": "Z", "%%": "%",
}
# Weekday names; Spark has no pattern that parses them.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
_ONE_LETTER = {"M", "d", "H", "h", "m", "s"}
# what %z reads: +0000, then +00:00 or Z
_OFFSETS = ["Z", "XXX"]


def _directives(fmt: str) -> list[str]:
    """A strptime format as directives and single literal characters."""
    out, i = [], 0
    while i < len(fmt):
        n = 2 if fmt[i] == "%" and i + 1 < len(fmt) else 1
        out.append(fmt[i:i + n])
        i += n
    return out


def strptime_to_spark(fmt: str, offset: str = "Z") -> str:
    """Translate a strptime format into a Spark datetime pattern (F2); weekday
    directives are left out (``to_ts`` takes the names off the text)."""
    parts, out = _directives(fmt), []
    for i, tok in enumerate(parts):
        if tok in ("%a", "%A"):
            continue
        if tok == "%z":
            out.append(offset)
        elif len(tok) == 2:
            if tok not in STRPTIME_TO_SPARK:
                raise ValueError(f"unsupported strptime directive {tok!r}")
            letters = STRPTIME_TO_SPARK[tok]
            beside = [p for p in (parts[i - 1] if i else "", parts[i + 1] if i + 1 < len(parts) else "")
                      if len(p) == 2 and p != "%%"]
            # fields without a separator have two digits
            out.append(letters * 2 if letters in _ONE_LETTER and beside else letters)
        else:
            out.append(f"'{tok}'" if tok.isalpha() else ("''" if tok == "'" else tok))
    return "".join(out)


def to_ts(c, fmt: str | None = None) -> Column:
    """parse to timestamp (by a strptime format, if given); unparsable -> NULL."""
    text, named = _c(c).cast("string"), F.lit(True)
    if fmt is None:
        return F.try_to_timestamp(text)
    for tok in ("%a", "%A"):
        if tok in _directives(fmt):
            names = "|".join(d if tok == "%A" else d[:3] for d in WEEKDAYS)
            pattern = rf"(?i)(?<![A-Za-z])(?:{names})(?![A-Za-z])"
            named = named & text.rlike(pattern)
            text = F.regexp_replace(text, pattern, "")
    offsets = _OFFSETS if "%z" in _directives(fmt) else _OFFSETS[:1]
    at = F.coalesce(*[F.try_to_timestamp(text, F.lit(strptime_to_spark(fmt, o))) for o in offsets])
    if "%y" in _directives(fmt):
        # Spark reads 00-99 as 2000-2099, strptime 69-99 as 1969-1999 (the same years are leap years)
        at = F.when(F.year(at).between(2069, 2099), at - F.expr("INTERVAL '100' YEAR")).otherwise(at)
    return F.when(named, at)


def parses_as(c, fmt: str) -> Column:
    """true when the text parses with the strptime format, or is missing."""
    return _c(c).isNull() | to_ts(c, fmt).isNotNull()


# Fixed values of stored texts: what stands for NULL and for the empty text in
# delimited files, the codes of signs that would break or bend a record, and
# the name Hive-style folders have for NULL.
STORED_NULL, STORED_EMPTY = "\\N", "\\e"
STORED_CODES = [("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r")]
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"
_MARK = "~"


def to_text(c, dtype: T.DataType) -> Column:
    """A value as text that ``from_text`` turns back into the very same value."""
    if isinstance(dtype, T.StringType):
        return _c(c)
    if isinstance(dtype, T.TimestampType):  # independent of the session's time zone
        return F.unix_micros(_c(c)).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(_c(c))
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return _c(c).cast("string")
    raise ValueError(f"{dtype.simpleString()} has no lossless text")


def from_text(c, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return _c(c)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(_c(c).cast("bigint"))
    if isinstance(dtype, T.BinaryType):
        return F.unhex(_c(c))
    return _c(c).cast(dtype)


def to_field(c, dtype: T.DataType) -> Column:
    """``to_text`` as a field of a delimited file: never NULL, empty or on two lines."""
    text = to_text(c, dtype)
    coded = text
    if isinstance(dtype, T.StringType):
        for sign, code in STORED_CODES:
            coded = F.replace(coded, F.lit(sign), F.lit(code))
    return F.when(text.isNull(), STORED_NULL).when(text == "", STORED_EMPTY).otherwise(coded)


def from_field(c, dtype: T.DataType) -> Column:
    text = _c(c)
    if isinstance(dtype, T.StringType):
        for sign, code in reversed(STORED_CODES):  # the sign that marks codes comes last
            text = F.replace(text, F.lit(code), F.lit(sign))
    text = F.when(_c(c) == STORED_NULL, F.lit(None)).when(_c(c) == STORED_EMPTY, "").otherwise(text)
    return from_text(text, dtype)


def to_partition(c, dtype: T.DataType) -> Column:
    """A value as the text of a partition folder: NULL stays NULL; a text that is empty, is named like
    the folder of NULL or starts with the mark gets the mark before it, so no two values share a folder."""
    text = to_text(c, dtype)
    return F.when((text == "") | (text == HIVE_NULL) | text.startswith(_MARK), F.concat(F.lit(_MARK), text)).otherwise(text)


def from_partition(c, dtype: T.DataType) -> Column:
    text = _c(c)
    return from_text(F.when(text.startswith(_MARK), F.substring(text, 2, 2**31 - 1)).otherwise(text), dtype)


def record_hash_md5(cols) -> Column:
    """null-aware digest of the listed columns (md5 hex text).

    Each part is cast to text, NULL is written as a fixed marker, parts are
    joined with a unit separator; equal to md5(concat_ws(...)) in SQL.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(HASH_SEP, *parts))


def with_lineage(df: DataFrame, source: str, run_ts: _dt.datetime | None = None,
                 ts_col: str = "extracted_at") -> DataFrame:
    """stamp source system and one fixed run timestamp per run."""
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return df.withColumns({
        "source_system": F.lit(source),
        ts_col: ts_literal(run_ts),
    })


def with_record_hash(df: DataFrame, cols=None, name: str = "record_hash") -> DataFrame:
    """T5 hash step: hash business columns first (before lineage is added)."""
    cols = list(cols or df.columns)
    return df.withColumn(name, record_hash_md5(cols))


def enrich_with_metadata(df: DataFrame, source_system: str,
                         load_timestamp: _dt.datetime | None = None) -> DataFrame:
    """T5: record hash over the business columns, then lineage columns."""
    hashed = with_record_hash(df)
    return with_lineage(hashed, source_system, load_timestamp, ts_col="load_timestamp")


def canonical_names(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """N5/F8 (lower-case, blanks -> '_') then N6 (canonical rename)."""
    df = df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])
    if mapping:
        df = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    return df


# The quote-schema rename applied after canonical_names.
QUOTE_RENAME = {
    "date": "trade_date", "open": "open_price", "high": "high_price",
    "low": "low_price", "close": "close_price", "adj_close": "adjusted_close",
}


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """recursively flatten struct columns into `a<sep>b` names; arrays kept."""
    def walk(dt, path, names):
        if isinstance(dt, T.StructType):
            out = []
            for f in dt.fields:
                out += walk(f.dataType, path + [f.name], names + [f.name])
            return out
        ref = F.col(".".join(f"`{p}`" for p in path))
        return [ref.alias(sep.join(names))]

    cols = []
    for f in df.schema.fields:
        cols += walk(f.dataType, [f.name], [f.name])
    return df.select(*cols)

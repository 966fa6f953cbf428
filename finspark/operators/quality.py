"""Declarative data-quality rules (V1-V16) evaluated in one Spark pass.

A rule set is a plain description (``Rules.completeness(...)`` etc.).
``evaluate(df, rule_sets)`` compiles every check of every rule set into
aggregate expressions, runs them as **one** global aggregate over ``df``
(one scan, partial aggregation per task; a second and further uniqueness
checks read their columns again), and turns the one-row result into
a long-form frame, lazily, on Spark:

    validator, check, column, passed BIGINT, failed BIGINT, ok BOOLEAN, details STRING(JSON), is_total BOOLEAN

Each validator also gets a totals row (``check = <validation type>``,
``is_total``) with the counts the source system reports for a whole validation result:
completeness counts cells, accuracy and consistency sum their checks, and
schema and row-count checks are all-or-nothing over the rows.

Only schema facts (column names, types) are decided on the driver; data is
never collected, except by ``raise_if_failed`` which reads the small result.
"""

from __future__ import annotations

import decimal
import logging
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.functions.scalar import parses_as

log = logging.getLogger(__name__)

RESULT_SCHEMA = ("validator STRING, check STRING, column STRING, passed BIGINT, "
                 "failed BIGINT, ok BOOLEAN, details STRING, is_total BOOLEAN")


# --------------------------------------------------------------- rule sets
@dataclass
class RuleSet:
    kind: str
    params: dict = field(default_factory=dict)


class Rules:
    """Constructors for the four validators of the source system."""

    @staticmethod
    def completeness(required_columns=(), null_threshold: float = 0, min_row_count: int = 1) -> RuleSet:
        return RuleSet("completeness", dict(required_columns=list(required_columns),
                                            null_threshold=null_threshold, min_row_count=min_row_count))

    @staticmethod
    def row_count_band(expected_count: int, tolerance: float = 0.1) -> RuleSet:
        return RuleSet("expected_record_count", dict(expected_count=expected_count, tolerance=tolerance))

    @staticmethod
    def accuracy(value_ranges=None, categorical_values=None, regex_patterns=None,
                 custom_rules=None) -> RuleSet:
        return RuleSet("accuracy", dict(value_ranges=value_ranges or {},
                                        categorical_values=categorical_values or {},
                                        regex_patterns=regex_patterns or {},
                                        custom_rules=custom_rules or {}))

    @staticmethod
    def consistency(data_types=None, unique_columns=(), date_formats=None,
                    cross_field_rules=()) -> RuleSet:
        return RuleSet("consistency", dict(data_types=data_types or {},
                                           unique_columns=list(unique_columns),
                                           date_formats=date_formats or {},
                                           cross_field_rules=list(cross_field_rules)))

    @staticmethod
    def schema(expected_schema: dict, allow_extra_columns: bool = True) -> RuleSet:
        return RuleSet("schema", dict(expected_schema=expected_schema,
                                      allow_extra_columns=allow_extra_columns))

    @staticmethod
    def custom(kind: str, **params) -> RuleSet:
        """A rule set of a validator added with ``register_validator``."""
        if kind not in _COMPILERS:
            raise ValueError(f"unknown validator {kind!r}; add it with register_validator")
        return RuleSet(kind, params)

    @staticmethod
    def from_config(cfg: dict) -> list[RuleSet]:
        """A per-dataset rule dict {validator: kwargs} -> rule sets."""
        out = []
        for kind, kw in cfg.items():
            ctor = {"completeness": Rules.completeness, "accuracy": Rules.accuracy,
                    "consistency": Rules.consistency, "schema": Rules.schema,
                    "expected_record_count": Rules.row_count_band}[kind]
            out.append(ctor(**kw))
        return out


VALIDATOR_NAME = {
    "completeness": "completeness_validator",
    "expected_record_count": "completeness_validator",
    "accuracy": "accuracy_validator",
    "consistency": "consistency_validator",
    "schema": "schema_validator",
}

# Rule set for the quote dataset, as configured by the source system.
STOCK_PRICE_RULES = {
    "completeness": {"required_columns": ["symbol", "trade_date", "close_price", "volume"],
                     "null_threshold": 5, "min_row_count": 1},
    "accuracy": {"value_ranges": {"open_price": (0, 100000), "high_price": (0, 100000),
                                  "low_price": (0, 100000), "close_price": (0, 100000),
                                  "volume": (0, 1e15)}},
    "consistency": {"data_types": {"symbol": "object", "trade_date": "datetime64[ns]",
                                   "close_price": "float64", "volume": "int64"}},
}

# Rule set for company statements, as configured by the source system.
COMPANY_FINANCIAL_RULES = {
    "completeness": {"required_columns": ["symbol", "fiscal_year", "revenue", "net_income"],
                     "null_threshold": 10},
    "accuracy": {"value_ranges": {"revenue": (0, 1e15), "net_income": (-1e15, 1e15)}},
}


# ------------------------------------------------------ type name helpers
def pandas_dtype(dt: T.DataType) -> str:
    """Name the source system's frame library would report for a Spark type."""
    return {
        T.ByteType: "int8", T.ShortType: "int16", T.IntegerType: "int32", T.LongType: "int64",
        T.FloatType: "float32", T.DoubleType: "float64", T.BooleanType: "bool",
        T.TimestampType: "datetime64[ns]", T.TimestampNTZType: "datetime64[ns]",
    }.get(type(dt), "object")


# Type families accepted by the schema check.
TYPE_FAMILIES = {
    "int": ["int64", "int32", "int16", "int8"],
    "float": ["float64", "float32", "float16"],
    "string": ["object", "string"],
    "bool": ["bool"],
    "datetime": ["datetime64", "datetime64[ns]"],
}


def type_compatible(actual: str, expected: str) -> bool:
    """Family match by substring, otherwise case-insensitive equality."""
    fam = TYPE_FAMILIES.get(expected.lower())
    if fam is not None:
        return any(a in actual for a in fam)
    return actual.lower() == expected.lower()


# ------------------------------------------------------------ predicates
def _is_missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        m = m | F.isnan(F.col(c))
    return m


def range_violation(c: str, lo, hi) -> Column:
    """Outside [lo, hi]; missing (NULL or NaN) is not a violation."""
    x = F.col(c)
    above = x > F.lit(hi)
    if isinstance(hi, (int, float, decimal.Decimal)):
        above = above & ~(x > F.lit(float("inf")))  # Spark orders NaN above all numbers
    return F.coalesce((x < F.lit(lo)) | above, F.lit(False))


def membership_violation(c: str, values) -> Column:
    """P5: not among the listed values; missing fails unless None is listed."""
    vals = [v for v in values if v is not None]
    ok = F.col(c).isin(vals) if vals else F.lit(False)
    if any(v is None for v in values):
        ok = ok | F.col(c).isNull()
    return ~F.coalesce(ok, F.lit(False))


def _text_form(df: DataFrame, c: str) -> Column:
    """Text form of a value as the source system tests it: missing text -> 'None',
    missing number -> 'nan', booleans as True / False, floats as ``python_float_text``."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.BooleanType):
        text = F.when(F.col(c), "True").when(~F.col(c), "False")
    elif isinstance(dt, (T.FloatType, T.DoubleType)):
        text = python_float_text(c)
    else:
        text = F.col(c).cast("string")
    return F.coalesce(text, F.lit("nan" if isinstance(dt, T.NumericType) else "None"))


def python_float_text(c: str) -> Column:
    """The text of a float as Python writes it: 10000000.0, 0.0001, 1e-05, 1e+16, nan, inf."""
    x, s = F.col(c), F.col(c).cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(s, "^(-?[0-9.]+)E", 1), r"\.0$", "")
    power = F.regexp_extract(s, "E(-?[0-9]+)$", 1).try_cast("int")
    signed = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    # wide enough for 17 digits anywhere between 1e-4 and 1e16
    plain = F.regexp_replace(s.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    size = F.abs(x)
    return (F.when(F.isnan(x), "nan").when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
            .when(x == 0, s).when((size >= 1e-4) & (size < 1e16), F.when(s.contains("E"), plain).otherwise(s))
            .when(F.length(power.cast("string")) >= 3, F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"),
                                                                F.abs(power).cast("string")))
            .otherwise(signed))


def regex_violation(df: DataFrame, c: str, pattern: str) -> Column:
    """The pattern must match at the start of the text form (not the whole).
    Patterns are written in Python syntax; named groups are translated."""
    return ~_text_form(df, c).rlike("^(?:" + normalize_pattern(pattern) + ")")


def custom_violation(c: str, rule: Callable[[Column], Column]) -> Column:
    """P7/UD1: rule(Column) -> boolean validity Column; NULL counts as invalid."""
    return ~F.coalesce(rule(F.col(c)), F.lit(False))


def cross_field_violation(c1: str, c2: str, rule: Callable[[Column, Column], Column]) -> Column:
    """P8/UD4: rule(Column, Column) -> boolean; NULL counts as a violation."""
    return ~F.coalesce(rule(F.col(c1), F.col(c2)), F.lit(False))


# --------------------------------------------------------------- compiler
def _key_digest(df: DataFrame, columns: list[str]) -> Column:
    """The columns' values, each as its text with the text's length before it, or as missing; texts of 32 bytes
    and more as their 256 bits, so that none of them equals a shorter one."""
    def part(c):
        dtype, v = df.schema[c].dataType, F.col(c)
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            v = v + F.lit(0.0).cast(dtype)  # -0.0 is 0.0
        if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
            v = F.to_json(F.struct(v), {"ignoreNullFields": "false"})
        text = F.hex(v) if isinstance(dtype, T.BinaryType) else v.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    text = F.concat(*[part(c) for c in columns])
    return F.when(F.octet_length(text) < 32, text.cast("binary")).otherwise(F.unhex(F.sha2(text, 256)))


class _Plan:
    """Collects aggregate expressions and the rows built from their results."""

    def __init__(self):
        self.aggs: list[Column | None] = []
        self.rows: list[Column] = []
        self.unique: dict[int, list[str]] = {}  # which numbers are counts of distinct keys, and of which columns

    def agg(self, expr: Column) -> Column:
        self.aggs.append(expr)
        return F.col(f"m{len(self.aggs) - 1}")

    def distinct(self, columns: list[str]) -> Column:
        """How many distinct values the columns have together; a missing value counts as a value."""
        self.unique[len(self.aggs)] = columns
        return self.agg(F.count_distinct(F.struct(*[F.col(c) for c in columns])))

    def run(self, df: DataFrame) -> DataFrame:
        """The one-row result.

        One distinct count stands in the aggregate with the rest.  Several would
        multiply every row with all its columns there (Expand); they have one
        scan of their own instead, which gives every key in a short form and counts
        the different ones (long keys by 256 bits: equal digests, equal keys).  Short
        keys stay as they are: they shuffle and spill in fewer bytes than a digest."""
        named = [e.alias(f"m{i}") for i, e in enumerate(self.aggs)]
        if len(self.unique) < 2:
            return df.agg(*named)
        none = F.lit(None).cast("bigint")
        plain = df.agg(*[none.alias(f"m{i}") if i in self.unique else e for i, e in enumerate(named)])
        keys = F.array(*[F.struct(F.lit(i).alias("i"), _key_digest(df, cols).alias("d")) for i, cols in self.unique.items()])
        counts = (df.select(F.explode(keys).alias("k")).select("k.i", "k.d").distinct()
                  .agg(*[F.count_if(F.col("i") == i).alias(f"m{i}") if i in self.unique else none.alias(f"m{i}")
                         for i in range(len(named))]))
        # one row each: every value is a count and stands in one of them
        return plain.unionAll(counts).agg(*[F.max(f"m{i}").alias(f"m{i}") for i in range(len(named))])

    def row(self, validator, check, column, passed, failed, ok, details: dict | None = None, total: bool = False):
        det = F.to_json(F.struct(*[F.lit(v).alias(k) if not isinstance(v, Column) else v.alias(k)
                                   for k, v in (details or {}).items()])) if details else F.lit(None)
        self.rows.append(F.struct(
            F.lit(validator).alias("validator"), F.lit(check).alias("check"),
            F.lit(column).cast("string").alias("column"),
            passed.cast("bigint").alias("passed"), failed.cast("bigint").alias("failed"),
            ok.cast("boolean").alias("ok"), det.cast("string").alias("details"),
            F.lit(total).alias("is_total")))


def _completeness(p: _Plan, df: DataFrame, n: Column, kw: dict):
    v = VALIDATOR_NAME["completeness"]
    oks = []
    mn = kw["min_row_count"]
    ok = n >= F.lit(mn)
    oks.append(ok)
    p.row(v, "min_row_count", None, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n), ok,
          {"expected": F.lit(mn), "actual": n})
    missing = sorted(set(kw["required_columns"]) - set(df.columns))
    ok = F.lit(not missing)
    oks.append(ok)
    p.row(v, "required_columns", None, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n), ok,
          {"missing_columns": F.array(*[F.lit(m) for m in missing]).cast("array<string>")})
    thr = kw["null_threshold"]
    null_cells = F.lit(0).cast("bigint")
    for c in df.columns:
        nulls = p.agg(F.count_if(_is_missing(df, c)))
        pct = F.when(n > 0, nulls / n * 100).otherwise(F.lit(0.0))
        ok = pct <= F.lit(float(thr))
        oks.append(ok)
        p.row(v, "null_threshold", c, n - nulls, nulls, ok,
              {"null_count": nulls, "null_percentage": F.round(pct, 2), "threshold": F.lit(thr)})
        null_cells = null_cells + nulls
    total_cells = n * F.lit(len(df.columns))
    all_ok = _all(oks)
    p.row(v, "completeness", None, total_cells - null_cells, null_cells, all_ok,
          {"row_count": n, "column_count": F.lit(len(df.columns)),
           "completeness_rate": F.round(F.when(total_cells > 0, (total_cells - null_cells)
                                                / total_cells * 100).otherwise(0.0), 2)}, total=True)


def _expected(p: _Plan, df: DataFrame, n: Column, kw: dict):
    v = VALIDATOR_NAME["expected_record_count"]
    exp, tol = kw["expected_count"], kw["tolerance"]
    lo, hi = exp * (1 - tol), exp * (1 + tol)
    ok = (n >= F.lit(lo)) & (n <= F.lit(hi))
    dev = F.round((n - F.lit(exp)) / F.lit(exp) * 100, 2) if exp > 0 else F.lit(0.0)
    p.row(v, "expected_record_count", None, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n),
          ok, {"expected": F.lit(exp), "actual": n, "tolerance": F.lit(tol),
               "range": F.array(F.lit(int(lo)), F.lit(int(hi))), "deviation": dev}, total=True)


def _accuracy(p: _Plan, df: DataFrame, n: Column, kw: dict):
    v = VALIDATOR_NAME["accuracy"]
    checks = []
    for c, (lo, hi) in kw["value_ranges"].items():
        if c in df.columns:
            checks.append(("value_range", c, range_violation(c, lo, hi), {"range": F.array(F.lit(lo), F.lit(hi))}))
    for c, vals in kw["categorical_values"].items():
        if c in df.columns:
            checks.append(("categorical_values", c, membership_violation(c, vals), {}))
    for c, pat in kw["regex_patterns"].items():
        if c in df.columns:
            checks.append(("regex_pattern", c, regex_violation(df, c, pat), {"pattern": F.lit(pat)}))
    for c, rule in kw["custom_rules"].items():
        if c in df.columns:
            try:
                viol = custom_violation(c, rule)
                df.select(viol).schema  # analysis now, so a broken rule is skipped here
            except Exception as e:  # noqa: BLE001 - a failing rule is logged, not counted
                log.error("custom rule on %s failed: %s", c, str(e).splitlines()[0])
                continue
            checks.append(("custom_rule", c, viol, {"rule": F.lit(getattr(rule, "__name__", "rule"))}))
    _sum_checks(p, v, "accuracy", n, checks)


def _consistency(p: _Plan, df: DataFrame, n: Column, kw: dict):
    v = VALIDATOR_NAME["consistency"]
    rows = []  # (check, column, passed, failed, ok)
    for c, expected in kw["data_types"].items():
        if c in df.columns:
            actual = pandas_dtype(df.schema[c].dataType)
            ok = F.lit(actual == expected)
            rows.append(("data_type", c, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n), ok,
                         {"expected": F.lit(expected), "actual": F.lit(actual)}))
    for u in kw["unique_columns"]:
        cols = [u] if isinstance(u, str) else list(u)
        if all(c in df.columns for c in cols):
            # rows beyond the first per value; a missing value counts as a value
            dups = n - p.distinct(cols)
            rows.append(("uniqueness", ",".join(cols), n - dups, dups, dups == 0, {"duplicates": dups}))
    for c, fmt in kw["date_formats"].items():
        if c in df.columns:
            bad = p.agg(F.count_if(~parses_as(c, fmt)))
            rows.append(("date_format", c, n - bad, bad, bad == 0,
                         {"expected_format": F.lit(fmt), "invalid_count": bad}))
    for c1, c2, rule in kw["cross_field_rules"]:
        if c1 in df.columns and c2 in df.columns:
            try:
                viol = cross_field_violation(c1, c2, rule)
                df.select(viol).schema
            except Exception as e:  # noqa: BLE001
                log.error("cross-field rule on %s,%s failed: %s", c1, c2, str(e).splitlines()[0])
                continue
            bad = p.agg(F.count_if(viol))
            rows.append(("cross_field", f"{c1},{c2}", n - bad, bad, bad == 0, {"violations": bad}))
    for check, col, passed, failed, ok, det in rows:
        p.row(v, check, col, passed, failed, ok, det)
    _totals(p, v, "consistency", [(r[2], r[3], r[4]) for r in rows])


def _schema(p: _Plan, df: DataFrame, n: Column, kw: dict):
    v = VALIDATOR_NAME["schema"]
    exp = kw["expected_schema"]
    oks = []
    missing = sorted(set(exp) - set(df.columns))
    ok = F.lit(not missing)
    oks.append(ok)
    p.row(v, "missing_columns", None, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n), ok,
          {"columns": F.array(*[F.lit(m) for m in missing]).cast("array<string>")})
    if not kw["allow_extra_columns"]:
        extra = sorted(set(df.columns) - set(exp))
        ok = F.lit(not extra)
        oks.append(ok)
        p.row(v, "extra_columns", None, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n), ok,
              {"columns": F.array(*[F.lit(m) for m in extra]).cast("array<string>")})
    for c, spec in exp.items():
        if c not in df.columns:
            continue
        if not spec.get("nullable", True):
            nulls = p.agg(F.count_if(_is_missing(df, c)))
            ok = nulls == 0
            oks.append(ok)
            p.row(v, "nullability", c, n - nulls, nulls, ok, {"null_count": nulls})
        if spec.get("type"):
            actual = pandas_dtype(df.schema[c].dataType)
            ok = F.lit(type_compatible(actual, spec["type"]))
            oks.append(ok)
            p.row(v, "data_type", c, F.when(ok, n).otherwise(0), F.when(ok, 0).otherwise(n), ok,
                  {"expected": F.lit(spec["type"]), "actual": F.lit(actual)})
    all_ok = _all(oks)
    p.row(v, "schema", None, F.when(all_ok, n).otherwise(0), F.when(all_ok, 0).otherwise(n), all_ok, total=True)


def _sum_checks(p: _Plan, v: str, total_name: str, n: Column, checks):
    rows = []
    for check, c, viol, det in checks:
        bad = p.agg(F.count_if(viol))
        rows.append((n - bad, bad, bad == 0))
        p.row(v, check, c, n - bad, bad, bad == 0, {**det, "violations": bad})
    _totals(p, v, total_name, rows)


def _totals(p: _Plan, v: str, name: str, rows):
    passed = sum((r[0] for r in rows), F.lit(0).cast("bigint"))
    failed = sum((r[1] for r in rows), F.lit(0).cast("bigint"))
    p.row(v, name, None, passed, failed, _all([r[2] for r in rows]),
          {"checks_performed": F.lit(len(rows))}, total=True)


def _all(oks: list[Column]) -> Column:
    out = F.lit(True)
    for o in oks:
        out = out & o
    return out


_COMPILERS = {"completeness": _completeness, "expected_record_count": _expected,
              "accuracy": _accuracy, "consistency": _consistency, "schema": _schema}


def register_validator(kind: str, checks: Callable[[DataFrame, dict], list],
                       validator: str | None = None) -> None:
    """UD5: add a validator, evaluated in the same single aggregate pass as
    the built-in ones.

    ``checks(df, params)`` returns ``(check, column, violation)`` triples,
    ``violation`` a row-level Column predicate (NULL counts as no
    violation).  Each check gets a result row with its violation count, and
    the validator a totals row named ``kind`` (sums over its checks, like
    accuracy).  Use it with ``Rules.custom(kind, **params)``.
    """
    if kind in _BUILT_IN:
        raise ValueError(f"{kind!r} is a built-in validator")
    name = validator or f"{kind}_validator"

    def compile_checks(p: _Plan, df: DataFrame, n: Column, kw: dict):
        triples = [(check, c, F.coalesce(viol, F.lit(False)), {})
                   for check, c, viol in checks(df, kw)]
        _sum_checks(p, name, kind, n, triples)

    _COMPILERS[kind] = compile_checks


_BUILT_IN = frozenset(_COMPILERS)


def evaluate(df: DataFrame, rule_sets) -> DataFrame:
    """Evaluate rule sets with one aggregate pass; long-form result (lazy)."""
    if isinstance(rule_sets, RuleSet):
        rule_sets = [rule_sets]
    p = _Plan()
    n = p.agg(F.count(F.lit(1)))
    for rs in rule_sets:
        _COMPILERS[rs.kind](p, df, n, rs.params)
    return p.run(df).select(F.explode(F.array(*p.rows)).alias("r")).select("r.*")


def summarize(results: DataFrame) -> DataFrame:
    """One row per validator from its totals row, with the success rate."""
    totals = results.where("is_total")
    total = F.col("passed") + F.col("failed")
    return totals.select(
        "validator", F.col("check").alias("validation_type"), "passed", "failed",
        total.alias("total"), "ok",
        F.coalesce(F.try_divide(F.col("passed").cast("double"), F.nullif(total, F.lit(0)))
                   * F.lit(100.0), F.lit(0.0)).alias("success_rate"))


def raise_if_failed(results: DataFrame, strict: bool = True) -> None:
    """In strict mode raise ValueError naming the failed validation(s).

    Reads only the small per-validator summary."""
    if not strict:
        return
    bad = summarize(results).where(~F.col("ok")).collect()
    if bad:
        msg = "; ".join(f"{r.validator} - {r.validation_type}. Failed records: {r.failed}/{r.total}"
                        for r in bad)
        raise ValueError(f"Validation failed: {msg}")


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """The violating rows of one check (a filter, lazily)."""
    return df.where(predicate)


def sample_violations(df: DataFrame, predicate: Column, column: str, order_by,
                      n: int = 5) -> DataFrame:
    """The first n violating values in a deterministic order."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.where(predicate).orderBy(*order_by).limit(n).select(*order_by, column)


def invalid_values(df: DataFrame, predicate: Column, column: str, n: int = 10) -> DataFrame:
    """The first n distinct violating values (sorted)."""
    return df.where(predicate).select(column).distinct().orderBy(column).limit(n)


def normalize_pattern(pattern: str) -> str:
    """Rewrite Python named groups ``(?P<n>...)`` / ``(?P=n)`` to the Java forms
    ``(?<n>...)`` / ``\\k<n>``."""
    pattern = re.sub(r"\(\?P<", "(?<", pattern)
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern)

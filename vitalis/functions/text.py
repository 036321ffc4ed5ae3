"""Scalar text functions (inventory 2.7) as Catalyst expressions.

Everything except Unicode NFKC and ``casefold`` stays inside whole-stage
codegen. Those two have no JVM built-in, so they run as Arrow-batched
pandas UDFs that are fed only the non-ASCII rows (NULL otherwise): ASCII
text is unchanged by NFKC, and ``lower`` equals ``casefold`` on ASCII.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalis import schemas as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- Unicode helpers ------------------------------------------------------

@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else v)


@F.pandas_udf(T.StringType())
def _casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda v: v.casefold() if isinstance(v, str) else v)


@F.pandas_udf(T.StructType([T.StructField("norm", T.StringType()),
                             T.StructField("fold", T.StringType())]))
def _nfkc_and_fold(s: pd.Series) -> pd.DataFrame:
    norm = s.map(lambda v: unicodedata.normalize("NFKC", v) if isinstance(v, str) else None)
    fold = norm.map(lambda v: v.casefold() if isinstance(v, str) else None)
    return pd.DataFrame({"norm": norm, "fold": fold})


def non_ascii(c: str | Column) -> Column:
    return _c(c).rlike("[^\\x00-\\x7F]")


# Python's str.split()/\s also treats the file/group/record/unit separators
# (0x1C-0x1F) as whitespace; Java's Unicode \s does not.
WHITESPACE_RE = "(?U)[\\s\\x1c-\\x1f]+"


def collapse_whitespace(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(_c(c), WHITESPACE_RE, " "))


def normalize_text(c: str | Column) -> Column:
    """``fn_normalize_text``: NFKC, collapse Unicode whitespace, strip."""
    col = _c(c)
    nfkc = F.coalesce(_nfkc(F.when(non_ascii(col), col)), col)
    return collapse_whitespace(nfkc)


def casefold(c: str | Column) -> Column:
    col = _c(c)
    return F.coalesce(_casefold(F.when(non_ascii(col), col)), F.lower(col))


def text_hash(c: str | Column) -> Column:
    """``fn_text_hash``: SHA-256 hex of the casefolded text."""
    return F.sha2(casefold(c), 256)


def normalize_with_hash(c: str | Column) -> tuple[Column, Column]:
    """Normalised text and SHA-256 of its casefold with a single Arrow UDF
    call (non-ASCII rows only). Whitespace collapse and casefold commute,
    so the hash equals ``text_hash(normalize_text(c))``."""
    col = _c(c)
    u = _nfkc_and_fold(F.when(non_ascii(col), col))
    norm = collapse_whitespace(F.coalesce(u["norm"], col))
    folded = collapse_whitespace(F.coalesce(u["fold"], F.lower(col)))
    return norm, F.sha2(folded, 256)


def record_id(key: str | Column, version: str = S.DATASET_VERSION) -> Column:
    """``fn_record_id``: SHA-256 of ``version:key`` (a stable key column
    replaces the source row position, which Spark does not keep)."""
    return F.sha2(F.concat_ws(":", F.lit(version), _c(key).cast("string")), 256)


# --- Clinical text template ----------------------------------------------

def age_phrase(age: str | Column = "AGE", agedays: str | Column = "AGEDAYS",
               cap_93: bool = True) -> Column:
    """``fn_age_phrase`` / ``fn_age_phrase_eda`` (``cap_93=False``)."""
    a, d = _c(age), _c(agedays)
    days = F.concat(F.lit("Age: "), d.cast("bigint").cast("string"), F.lit(" days."))
    years = F.concat(F.lit("Age: "), a.cast("bigint").cast("string"), F.lit(" years."))
    expr = F.when((a == 0) & d.between(0, 365), days)
    if cap_93:
        expr = expr.when(a == 93, F.lit("Age: 93 years or older."))
    return expr.otherwise(years)


def ordered_distinct(cols: Sequence[str | Column]) -> Column:
    """``win_dedupe_keep_first``: non-null values, first occurrence order."""
    return F.array_distinct(F.array_compact(F.array(*[_c(c) for c in cols])))


def complaint_phrase(cols: Sequence[str | Column], dedupe: bool = True) -> Column:
    """``fn_complaint_phrase`` (distinct, ordered) / ``_eda`` (repeats kept).
    NULL when there is no complaint, so ``concat_ws`` omits it."""
    arr = ordered_distinct(cols) if dedupe else F.array_compact(F.array(*[_c(c) for c in cols]))
    return F.when(F.size(arr) > 0,
                  F.concat(F.lit("Reasons for visit: "), F.array_join(arr, "; "), F.lit(".")))


def _fmt(template: str, *vals: Column) -> Column:
    """Fill ``{}`` slots of a fixed template with string columns."""
    pieces = template.split("{}")
    out: list[Column] = []
    for i, p in enumerate(pieces):
        if p:
            out.append(F.lit(p))
        if i < len(vals):
            out.append(vals[i])
    return F.concat(*out)


def _f1(c: Column) -> Column:
    return F.format_string("%.1f", c)


def _f0(c: Column) -> Column:
    return F.format_string("%.0f", c)


def _int(c: Column) -> Column:
    return c.cast("bigint").cast("string")


def observation_phrase(eda: bool = False) -> Column:
    """``fn_observation_phrase``: fixed order and units over the cleaned
    vital columns. The training variant rounds (``{:.0f}``) and writes a
    one-sided blood pressure; the EDA variant truncates and needs both."""
    t, hr, rr = F.col("temperature_f"), F.col("heart_rate"), F.col("respiratory_rate")
    sb, db = F.col("systolic_bp"), F.col("diastolic_bp")
    ox, pn = F.col("oxygen_saturation"), F.col("pain_scale")
    num = _int if eda else _f0
    bp = F.when(sb.isNotNull() & db.isNotNull(), _fmt(S.OBS_BP_BOTH, _int(sb), _int(db)))
    if not eda:
        bp = (bp.when(sb.isNotNull(), _fmt(S.OBS_BP_SYS, _int(sb)))
                .when(db.isNotNull(), _fmt(S.OBS_BP_DIA, _int(db))))
    parts = [
        F.when(t.isNotNull(), _fmt(S.OBS_TEMPERATURE, _f1(t))),
        F.when(hr.isNotNull(), _fmt(S.OBS_HEART_RATE, num(hr))),
        F.when(rr.isNotNull(), _fmt(S.OBS_RESP_RATE, num(rr))),
        bp,
        F.when(ox.isNotNull(), _fmt(S.OBS_OXYGEN, num(ox))),
        F.when(pn.isNotNull(), _fmt(S.OBS_PAIN, num(pn))),
    ]
    joined = F.concat_ws("; ", *parts)
    return F.when(joined != "", F.concat(F.lit("Triage observations: "), joined, F.lit(".")))


def clinical_text(eda: bool = False) -> Column:
    """``fn_clinical_text`` / ``fn_clinical_text_eda``: the whole template in
    one expression over the decoded, cleaned row (no UDF)."""
    desc = [f"{c}_description" for c in S.RFV_COLUMNS]
    return F.concat_ws(
        " ",
        age_phrase(cap_93=not eda),
        F.concat(F.lit("Sex: "), F.col("sex_label"), F.lit(".")),
        complaint_phrase(desc, dedupe=not eda),
        observation_phrase(eda=eda),
    )


# --- Other scalar functions ------------------------------------------------

def diag_normalize(c: str | Column) -> Column:
    """``fn_diag_normalize``: strip, drop dots, strip trailing dashes;
    '', -9, -8, -7 -> NULL."""
    v = F.regexp_replace(F.regexp_replace(F.trim(_c(c).cast("string")), "\\.", ""), "-+$", "")
    return F.when(~v.isin("", "-9", "-8", "-7"), v)


def signature(cols: Sequence[str | Column], sep: str = " | ") -> Column:
    """``fn_signature``: values joined with NULL as ''."""
    return F.concat_ws(sep, *[F.coalesce(_c(c), F.lit("")) for c in cols])


# Token patterns (fixed values): training vectoriser, and the pooled-model
# word pattern (Unicode word characters between word boundaries).
TOKEN_RE_ASCII = "([A-Za-z0-9_]{2,})"
TOKEN_RE_UNICODE = "(?U)\\b\\w+\\b"
# Default word pattern of the comparison vectoriser: 2+ word characters.
TOKEN_RE_DEFAULT = "(?U)\\b\\w\\w+\\b"


def tokenize(c: str | Column, pattern: str = TOKEN_RE_ASCII, group: int = 1) -> Column:
    """``fn_tokenize_*``: lower-case then all regex matches, in order."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(pattern), group)


def token_count(c: str | Column) -> Column:
    """``fn_token_count``: whitespace-separated tokens (0 for blank text)."""
    t = F.trim(F.regexp_replace(_c(c), WHITESPACE_RE, " "))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, " ")))


def ngrams_1_2(tokens: str | Column) -> Column:
    """``fn_ngrams``: unigrams followed by space-joined bigrams. Pass a
    column reference: ``zip_with`` over two slices reads each array once
    (a lambda indexing into an inlined expression would re-run it per
    element)."""
    tk = _c(tokens)
    m = F.greatest(F.size(tk) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(tk, 1, m), F.slice(tk, 2, m), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(tk, bigrams)


def status(passed: str | Column) -> Column:
    """``fn_bucket_target_status``: PASS / FAIL."""
    return F.when(_c(passed), F.lit("PASS")).otherwise(F.lit("FAIL"))


def format_currency(c: str | Column) -> Column:
    """``fn_format_currency``: ``US$ 1,500`` (no decimals)."""
    return F.concat(F.lit("US$ "), F.format_number(_c(c), 0))


def format_percent(c: str | Column) -> Column:
    """``fn_format_percent``: ``15.3%`` from a ratio."""
    return F.concat(F.format_number(_c(c) * 100, 1), F.lit("%"))


def valid_version(c: str | Column) -> Column:
    """``fn_version_pattern``: commit id is ``local`` or 40 hex digits."""
    return (_c(c) == "local") | _c(c).rlike("^[0-9a-fA-F]{40}$")

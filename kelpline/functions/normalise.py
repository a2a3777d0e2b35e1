"""Column functions: normalised dimension values, and what is wrong with a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that are never part of a dimension value, and spellings of "unknown", "off" and "auto".
_INVISIBLE = "[\\x00-\\x1F\\x7F\\u00A0\\u200B-\\u200D\\uFEFF]"
_UNKNOWN = ("", "unk", "und", "nil", "null", "na", "n/a", "undefined", "unknown")
_OFF = ("off", "non", "none", "disabled")
_AUTO = ("aut", "auto")
#: Event times outside [2020-01-01, 2035-01-01) UTC are not believed.
EARLIEST_S, LATEST_S = 1_577_836_800, 2_051_222_400


def norm_scrub(value: Column) -> Column:
    """Without control characters, no-break and zero-width spaces and byte order marks; inner spaces stay."""
    return F.regexp_replace(value.cast("string"), _INVISIBLE, "")


def norm_case(value: Column) -> Column:
    return F.lower(F.trim(norm_scrub(value)))


def norm_lang(value: Column) -> Column:
    """The primary subtag: what comes before the first hyphen."""
    return F.split_part(norm_case(value), F.lit("-"), F.lit(1))


def norm_version(value: Column) -> Column:
    return norm_case(value)


def norm_app_version(value: Column) -> Column:
    """Three numbers followed by nothing but zeros lose the zeros."""
    return F.regexp_replace(norm_case(value), r"^(\d+\.\d+\.\d+)(?:\.0+)+$", "$1")


def lang_class(value: Column) -> Column:
    lang = norm_lang(value)
    return F.when(lang.isin(*_UNKNOWN), "unknown").when(lang.isin(*_OFF), "off").when(lang.isin(*_AUTO), "auto").otherwise("named")


def ts_in_range(seconds: Column) -> Column:
    return F.coalesce((seconds >= EARLIEST_S) & (seconds < LATEST_S), F.lit(False))


def valid_utf8(value: Column) -> Column:
    return F.coalesce(F.is_valid_utf8(value), F.lit(True))


def q_reason(session: Column, user: Column, seconds: Column) -> Column:
    """Why a row can't be modelled, the first reason that holds; '' if it can."""
    return (
        F.when(~valid_utf8(session) | ~valid_utf8(user), "identity_not_utf8")
        .when(F.coalesce(F.trim(norm_scrub(session)), F.lit("")) == "", "session_id_unusable")
        .when(~ts_in_range(seconds), "ts_out_of_range")
        .otherwise("")
    )


def q_flags(session: Column, user: Column, seconds: Column, session_start: Column, content_id: Column, dims_valid: Column) -> Column:
    """All that is odd about a row which is modelled nevertheless."""
    padded = (session != F.trim(session)) | (user != F.trim(user))
    flags = [
        ("user_id_empty", F.coalesce(F.trim(norm_scrub(user)), F.lit("")) == ""),
        ("event_before_session_start", ts_in_range(session_start) & (session_start > seconds)),
        ("session_start_out_of_range", ~ts_in_range(session_start)),
        ("content_id_rollup_sentinel", content_id == -1),
        ("dimension_not_utf8", ~dims_valid),
        ("identity_padded", padded),
    ]
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), n).otherwise("") for n, c in flags]), lambda x: x != "")

"""Scalar Column functions (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (
    AVAILABILITY_CODES,
    BINARY_CLASSIFIER,
    DOWNLOAD_COMMAND_PREFIX,
    EXTENSION_FIXES,
    SHA1_MAX_LEN,
    UINFO_MAX_LEN,
    UNSTABLE_VERSION_WORDS,
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_key(uinfo: Column | str) -> Column:
    """16-byte MD5 of the full coordinate string (PRJ-1)."""
    return F.unhex(F.md5(_c(uinfo).cast(T.BinaryType())))


def key_hex(key: Column | str, upper: bool = False) -> Column:
    """Printable form of a binary key: lower-case hex (= ``md5()``), or upper (= ``HEX``)."""
    h = F.hex(_c(key))
    return h if upper else F.lower(h)


def availability_code(name: Column | str) -> Column:
    """Enum name -> ordinal; unknown names give NULL (PRJ-8)."""
    m = F.create_map(*[x for k, v in AVAILABILITY_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, _c(name)).cast(T.IntegerType())


def truncate_uinfo(uinfo: Column | str) -> Column:
    return F.left(_c(uinfo), F.lit(UINFO_MAX_LEN))


def sha1_prefix(sha1: Column | str) -> Column:
    return F.left(_c(sha1), F.lit(SHA1_MAX_LEN))


# Last millisecond that rounds to a DATETIME (9999-12-31 23:59:59).
MAX_DATETIME_MS = 253402300799499


def epoch_ms_to_datetime(ms: Column | str) -> Column:
    """Epoch milliseconds -> second-precision TIMESTAMP_NTZ, half-up rounded; NULL if
    negative or past 9999-12-31 23:59:59.

    Independent of the session time zone. Nothing is added to ``ms`` itself, so a
    corrupt value near the long range gives NULL instead of an overflow error.
    """
    ms = _c(ms)
    secs = (F.floor(ms / F.lit(1000)) + F.when(ms % 1000 >= 500, 1).otherwise(0)).cast(T.LongType())
    ts = F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType()))
    return F.when((ms >= 0) & (ms <= F.lit(MAX_DATETIME_MS)), ts)


def fix_extension(group_id: Column | str, artifact_id: Column | str,
                  file_extension: Column | str, fixes=EXTENSION_FIXES) -> Column:
    """Apply the known-bad-data extension fixes (PRJ-14)."""
    out = None
    for g, a, wrong, right in fixes:
        cond = (_c(group_id) == g) & (_c(artifact_id) == a) & (_c(file_extension) == wrong)
        out = F.when(cond, F.lit(right)) if out is None else out.when(cond, F.lit(right))
    return _c(file_extension) if out is None else out.otherwise(_c(file_extension))


def group_prefix(group_id: Column | str, k: int) -> Column:
    """First ``k`` dot-separated parts; fewer parts give the whole string (PRJ-15)."""
    return F.substring_index(_c(group_id), ".", k)


def is_stable_version(version: Column | str, words=UNSTABLE_VERSION_WORDS) -> Column:
    """Version not null and containing none of the unstable words (FLT-4)."""
    low = F.lower(_c(version))
    cond = _c(version).isNotNull()
    for w in words:
        cond = cond & ~low.contains(w)
    return cond


def is_binary_classifier(classifier: Column | str) -> Column:
    """No classifier, or the binary classifier (FLT-5)."""
    return _c(classifier).isNull() | (_c(classifier) == BINARY_CLASSIFIER)


def download_command(group_id, artifact_id, version, file_extension, classifier) -> Column:
    """Colon-joined coordinates behind the download command prefix (PRJ-17)."""
    base = [_c(group_id), F.lit(":"), _c(artifact_id), F.lit(":"), _c(version), F.lit(":"),
            _c(file_extension)]
    return F.concat(
        F.lit(DOWNLOAD_COMMAND_PREFIX),
        F.when(_c(classifier).isNull(), F.concat(*base)).otherwise(
            F.concat(*base, F.lit(":"), _c(classifier))),
    )


def byte_length(s: Column | str) -> Column:
    """Length in bytes of the UTF-8 text (PRJ-20)."""
    return F.octet_length(_c(s))


#: The rows of a JSON document at a path (SQL over ``{doc}`` and ``{path}``): the elements of an array,
#: or an object as the only one. A scalar, a null and a missing path have none, and a text that is
#: not JSON (empty and blank too) is like a null. The document is parsed once, as the only element that the
#: lambda is called for; that a value is an object is told by its cast to a struct of no fields, which looks at
#: no value within.
JSON_ELEMENTS = r"""
        CASE WHEN left(ltrim(' \t\r\n', {doc}), 1) IN ('{{', '[') THEN
             get(transform(array(try_variant_get(try_parse_json({doc}), {path}, 'variant')), found ->
                 coalesce(try_variant_get(found, '$', 'array<variant>'),
                          CASE WHEN try_variant_get(found, '$', 'struct<>') IS NOT NULL THEN array(found) END)), 0) END"""


def json_elements(doc: str, path: str = "$") -> Column:
    """The rows of the JSON documents in column ``doc`` at ``path``, as an array of variants (JOIN-6)."""
    return F.expr(JSON_ELEMENTS.format(doc=f"`{doc}`", path="'" + path.replace("'", "\\'") + "'"))

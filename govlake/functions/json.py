"""Guarded JSON access.

The views read JSON through a "safe parse" whose failure result is an object
carrying an ``error`` key, and every field read is guarded by "the ``error``
field is NULL". Both cases reduce to one rule, which we apply once when the
text is parsed: a document is usable only if it is strict JSON *and* its
top-level ``error`` member is absent or JSON null. Unusable documents become
SQL NULL, so every later path read yields NULL exactly where the guarded
expression would.

Parsing goes to VARIANT (parsed once, binary-encoded; later path reads do not
re-parse). ``try_parse_json`` tolerates trailing text after a complete value, so
a text counts as JSON only if it parses inside ``[...]``, as a one-element array,
and inside ``{"v":...}`` too: whatever closes the first kind of bracket early is
an error in the other. A repeated key keeps its last value; that is the session setting
``spark.sql.variant.allowDuplicateKeys`` (see session.py), checked here.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"
# Fixed values of the data format.
EVENT_PREFIX = "EVENT_JSON:"
INVALID_ARGS_JSON = '{"value":"invalid json"}'


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strict_json_sql(text: str) -> str:
    """SQL expression of the strict rule: VARIANT of a text expression, or NULL."""
    one = f"try_variant_get(try_parse_json(concat('[', {text}, ']')), '$', 'array<variant>')"
    member = f"try_parse_json(concat('{{\"v\":', {text}, '}}'))"
    return f"CASE WHEN size({one}) = 1 AND {member} IS NOT NULL THEN get({one}, 0) END"


def _require_duplicate_keys() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(DUPLICATE_KEYS, "false") != "true":
        raise RuntimeError(f"{DUPLICATE_KEYS} must be true: a document that repeats a key would be dropped")


def _strict(t: Column) -> Column:
    """A text with its strict parse: struct (t, one), ``one`` the elements of ``[text]``."""
    one = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>")
    return F.named_struct(F.lit("t"), t, F.lit("one"), one)


def _document(s: Column) -> Column:
    """The document of a ``_strict`` struct; a text without "]" can't close the bracket early, so only others are parsed twice."""
    whole = ~F.contains(s["t"], F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"v":'), s["t"], F.lit("}"))).isNotNull()
    return F.when((F.size(s["one"]) == 1) & whole, F.get(s["one"], 0))


def parse_json_strict_each(texts) -> Column:
    """Strict JSON texts of an array -> array of VARIANT; NULL elements for NULL, empty, invalid or trailing text.

    Lambda variables hold what is read twice: Spark evaluates a repeated expression of a CASE again for each place it has there.
    """
    _require_duplicate_keys()
    return F.transform(F.transform(_c(texts), _strict), _document)


def parse_json_strict(text) -> Column:
    """Strict JSON text -> VARIANT; NULL for NULL, empty, invalid or trailing text."""
    return F.get(parse_json_strict_each(F.array(_c(text))), 0)


def guard(v: Column) -> Column:
    """Keep a parsed document only when its top-level ``error`` is absent/null."""
    return F.when(F.try_variant_get(v, "$.error", "string").isNull(), v)


def safe_json_each(texts) -> Column:
    """Parse + guard of every text of an array."""
    return F.transform(parse_json_strict_each(texts), guard)


def safe_json(text) -> Column:
    """Parse + guard: the usable document or NULL."""
    return F.get(safe_json_each(F.array(_c(text))), 0)


def strip_event_prefix(log) -> Column:
    """Remove every occurrence of the event-log marker."""
    return F.replace(_c(log), F.lit(EVENT_PREFIX), F.lit(""))


def log_event_json(log) -> Column:
    """A log line as a guarded document (plain text lines become NULL)."""
    return safe_json(strip_event_prefix(log))


def log_event_docs(logs) -> Column:
    """``log_event_json`` of every line of an array, order kept."""
    return safe_json_each(F.transform(_c(logs), strip_event_prefix))


def jstr(v: Column, path: str) -> Column:
    """``->>`` style read: scalar as text, object/array as JSON text."""
    return F.try_variant_get(v, path, "string")


def jnum(v: Column, path: str) -> Column:
    """``(->>)::NUMERIC`` read as DECIMAL(38,0); non-numeric text gives NULL."""
    return jstr(v, path).try_cast("decimal(38,0)")


def b64_text(b64) -> Column:
    """base64 text -> UTF-8 text; NULL for bad base64 or bad UTF-8."""
    raw = F.try_to_binary(_c(b64), F.lit("base64"))
    return F.try_validate_utf8(raw.cast("string"))


def b64_encode(binary) -> Column:
    """bytes -> base64 text without line wrapping."""
    return F.replace(F.base64(_c(binary)), F.lit("\r\n"), F.lit(""))


def json_text_or_fallback(text) -> Column:
    """Ingest-side rule: valid JSON text is kept, anything else becomes the fallback object."""
    _require_duplicate_keys()
    kept = F.transform(F.transform(F.array(_c(text)), _strict), lambda s: F.when(_document(s).isNotNull(), s["t"]))
    return F.coalesce(F.get(kept, 0), F.lit(INVALID_ARGS_JSON))


def args_json_text(b64) -> Column:
    """Ingest-side decode of base64 args (bad base64 / UTF-8 / JSON -> fallback)."""
    return json_text_or_fallback(b64_text(b64))

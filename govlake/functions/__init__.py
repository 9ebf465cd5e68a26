"""Column expressions used inside the Spark jobs (all JVM-side built-ins)."""

from govlake.functions.json import (  # noqa: F401
    b64_text, guard, jnum, jstr, log_event_json, parse_json_strict, safe_json, strip_event_prefix,
)
from govlake.functions.text import after_first_dot, concat_skip_null, md5_concat  # noqa: F401
from govlake.functions.time import epoch_ns, floor_div, ns_to_timestamp  # noqa: F401

from tidecast.functions.expr import (  # noqa: F401
    md5_uniform,
    ntz_from_micros,
    ntz_micros,
    rnd,
    safe_div,
    warm,
)

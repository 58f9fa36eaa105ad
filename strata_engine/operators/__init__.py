"""DataFrame → DataFrame operators."""

from strata_engine.operators import (  # noqa: F401
    clean,
    moments,
    profile,
    quality,
    ranking,
    report,
    scale,
    schema,
    split,
    strata,
    summary,
    transform,
    verdicts,
)

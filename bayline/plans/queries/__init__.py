"""Importing this package registers all queries."""

from bayline.plans.queries import (  # noqa: F401
    columns,
    joins,
    kpis,
    quality,
    cleaning,
    features,
    statistics,
    segments,
    models,
    experiments,
    marts,
    files,
    streams,
    monitoring,
)

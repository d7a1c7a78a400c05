"""All registered queries; importing a module registers its queries."""

from stayline.plans import (  # noqa: F401
    etl,
    evaluation,
    formats,
    models,
    monitoring,
    reports,
    retrieval,
    segmentation,
    splits,
    storage,
    streams,
)
from stayline.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

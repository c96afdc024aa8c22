"""All queries of the core."""

from __future__ import annotations

from voxloom.plans import corpus, evaluation, segmentation, speakers, text_quality, work  # noqa: F401
from voxloom.plans.base import QUERIES, SQL


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)

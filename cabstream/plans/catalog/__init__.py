"""All registered queries and their reference SQL."""

from cabstream.plans.catalog import (
    cleaning, curated, demand, features, geospatial, kpis, matches, storage, streams)
from cabstream.plans.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cleaning", "curated", "demand", "features", "geospatial", "kpis",
           "matches", "storage", "streams"]

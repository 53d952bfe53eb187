"""Imports every catalogue module so that its queries register."""

from __future__ import annotations

import importlib

MODULES = [
    "panelforge.plans.catalog_returns",
    "panelforge.plans.catalog_panel",
    "panelforge.plans.catalog_outliers",
    "panelforge.plans.catalog_quality",
    "panelforge.plans.catalog_series",
    "panelforge.plans.catalog_models",
    "panelforge.plans.catalog_selection",
    "panelforge.plans.catalog_dashboards",
    "panelforge.plans.catalog_sources",
    "panelforge.plans.catalog_misc",
]


def _load():
    for m in MODULES:
        importlib.import_module(m)
    from panelforge.plans import catalog

    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracle_sql():
    return dict(_load().ORACLE)

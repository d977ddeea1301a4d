"""Imports every module that registers queries."""

from wayline.workload import (q_aggregates, q_columns, q_models, q_relational, q_sources, q_text,  # noqa: F401
                              q_writes)  # noqa: F401

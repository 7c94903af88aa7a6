"""Imports every catalogue module so that the registry is filled."""

from corpusloom.plans import chat_queries, file_queries, instruct_queries, kd_queries, mc_queries, score_queries, train_queries, template_queries, misc_queries  # noqa: F401
from corpusloom.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]

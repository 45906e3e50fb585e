"""Imports every query module so that the registry is complete."""

from . import q_batch, q_builders, q_corpus, q_eval, q_groups, q_rewards, q_tokens  # noqa: F401
from .catalog import ORACLES, QUERIES  # noqa: F401

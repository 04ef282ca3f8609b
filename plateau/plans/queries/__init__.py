"""Registered queries, grouped by area. Importing registers them."""

from plateau.plans.queries import (content, evaluate, events, explore, profiles, ranker, recommend,  # noqa: F401
                                   reconcile, text, training)

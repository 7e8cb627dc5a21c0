from careflow.plans.facts import FACTS, build_fact
from careflow.plans.summaries import SUMMARIES, Dimensions, build_summary

__all__ = ["FACTS", "SUMMARIES", "Dimensions", "build_fact", "build_summary"]

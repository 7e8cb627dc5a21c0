from careflow.streaming.jobs import dimension_job, fact_job, facts_job, lookup_job, store_dimensions, summary_job

__all__ = ["dimension_job", "fact_job", "facts_job", "lookup_job", "store_dimensions", "summary_job"]

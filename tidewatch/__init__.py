"""tidewatch: issue analytics on Spark.

DataFrame in, DataFrame out. Raw news and community posts are cleaned,
tagged with entities and problem categories, scored, aggregated per
(entity, category), folded into versioned state snapshots, scored into one
severity value and rendered as alert payloads.

Layout:
  functions/  Column expressions (text cleanup, time parsing, score math)
  operators/  DataFrame -> DataFrame steps (tagging, aggregation, state, issues)
  sources/    readers / writers, record extraction from raw pages
  plans/      composed batch jobs (news, community, replay)
  streaming/  incremental news job over newly arrived files
"""

__version__ = "0.1.0"

"""refinery: a layered (bronze / silver / gold) sales warehouse on Spark.

Raw CRM and ERP extracts are ingested as typed bronze tables, cleaned by six
silver jobs, and joined into a star schema (two dimensions, one fact) with
dense surrogate keys and a data-quality report.  Everything is DataFrame / SQL
so that Catalyst and AQE plan it; the only Python that runs inside tasks is an
Arrow-batched running sum used by the dense key.

Sub-packages:
  functions/  Column -> Column cleaning rules (codes, dates, measures, ids)
  operators/  DataFrame -> DataFrame building blocks (frames, keys, joins, aggregates)
  sources/    schemas, fixtures over the test tables, CSV ingest, table IO
  plans/      the silver and gold jobs, the quality report, the query catalog
  streaming/  incremental bronze ingest with Structured Streaming
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]

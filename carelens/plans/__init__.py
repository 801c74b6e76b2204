"""The jobs: silver, gold, KPI views, measures, reports, validation and the pipeline that runs them."""

"""Star-schema builders, KPIs and the end-to-end pipeline."""

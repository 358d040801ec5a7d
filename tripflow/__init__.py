"""tripflow: layered table pipelines and a tested relational surface on PySpark."""

"""Training-data operators. Nothing outside this folder and
``corpus_pipeline.py`` imports it; ``__spark_entry__.py`` registers its queries
when the folder is present."""

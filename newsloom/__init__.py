"""News analytics as Spark jobs: clean, analyse, score and load batches of documents."""

"""Racing timing analytics as plain PySpark jobs: raw files to cleaned tables to answers."""

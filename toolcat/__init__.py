"""toolcat: a Spark-native catalogue of scientific tools and workflows, with corpus operators in ``toolcat.llm``."""

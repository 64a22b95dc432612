"""skein: a Spark-first engine that prepares and audits training corpora."""

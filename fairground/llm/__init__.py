"""Operations of a training-data pipeline, as Spark jobs. Nothing outside this subpackage imports it."""

"""Operations of large text-corpus preparation, as Spark jobs."""

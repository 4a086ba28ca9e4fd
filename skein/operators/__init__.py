"""DataFrame -> DataFrame operators of the pipeline and around it."""

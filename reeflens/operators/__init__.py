"""DataFrame -> DataFrame operators of the survey analysis."""

"""Tables and analyses: (DataFrames, StudyConfig) -> DataFrame."""

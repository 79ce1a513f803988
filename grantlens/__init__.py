"""grantlens: grant-lifecycle analytics as PySpark DataFrame functions."""

from grantlens.config import DEFAULT_CONFIG, StudyConfig

__all__ = ["DEFAULT_CONFIG", "StudyConfig"]

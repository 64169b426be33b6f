from . import jobs, scoring  # noqa: F401

from . import jsonl  # noqa: F401

from . import responses  # noqa: F401

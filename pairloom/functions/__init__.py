from . import bind, cells, draws, render, sqltext  # noqa: F401

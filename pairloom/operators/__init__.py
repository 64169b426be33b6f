from . import band, chats, execute, fixtures, metrics, pairs, positions, skew, splits, verdicts  # noqa: F401

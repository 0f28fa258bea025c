"""Values shared by the trip tests; a module of its own, as any folder's conftest can hide another's."""

import datetime as dt


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)

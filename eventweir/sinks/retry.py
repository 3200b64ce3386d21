"""What may be tried again, and how often.

Whether an error is passing is read from its class and its SQL state, never from its text: texts
quote the values that failed, and a value may read like anything.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from typing import Any

log = logging.getLogger(__name__)

# Classes, with all below them, of lost connections and lost transactions.
TRANSIENT_CLASSES = {
    "java.sql.SQLTransientException",
    "java.sql.SQLRecoverableException",
    "java.sql.SQLNonTransientConnectionException",
    "java.net.SocketException",
    "java.net.SocketTimeoutException",
    "java.net.UnknownHostException",
}
# Classes of SQL states for connection, rollback, resources and operator intervention.
TRANSIENT_STATES = ("08", "40", "53", "57P")


def _state_is_transient(state: Any) -> bool:
    return isinstance(state, str) and state.startswith(TRANSIENT_STATES)


def _java_errors(error: BaseException) -> Iterator[Any]:
    """The JVM exceptions behind an error of PySpark, outermost first."""
    seen = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    while seen is not None:
        yield seen
        seen = seen.getCause()


def _java_is_transient(error: Any) -> bool:
    kind, names = error.getClass(), set()
    while kind is not None:
        names.add(kind.getName())
        kind = kind.getSuperclass()
    if names & TRANSIENT_CLASSES:
        return True
    return "java.sql.SQLException" in names and _state_is_transient(error.getSQLState())


def is_transient(error: BaseException) -> bool:
    """Whether a later attempt can succeed with the same data."""
    seen: BaseException | None = error
    while seen is not None:
        if isinstance(seen, ConnectionError | TimeoutError) or _state_is_transient(getattr(seen, "sqlstate", None)):
            return True
        if any(_java_is_transient(java) for java in _java_errors(seen)):
            return True
        seen = seen.__cause__
    return False


def with_retries(
    action: Callable[[], None], retries: int, pause: float = 1.0, transient: Callable[[BaseException], bool] = is_transient
) -> None:
    """Run ``action``; on a transient failure run it again, up to ``retries`` times more. Any
    other failure, such as a bad value, is raised at once."""
    for attempt in range(retries + 1):
        try:
            return action()
        except Exception as error:
            if attempt == retries or not transient(error):
                raise
            log.warning("write failed, retry %d of %d: %s", attempt + 1, retries, error)
            time.sleep(pause * (attempt + 1))

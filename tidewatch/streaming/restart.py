"""Running a job until it is through, over failures of its sink."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

logger = logging.getLogger(__name__)

#: Tries in a row that may fail, and the seconds before the first of them is repeated.
TRIES, PAUSE = 5, 1.0
#: The longest pause in seconds.
LONGEST = 60.0


class GaveUp(RuntimeError):
    """A job failed as often as it may without getting on."""


def run_until_done(
    starter: Callable[[], StreamingQuery], tries: int = TRIES, pause: float = PAUSE, sleep: Callable[[float], None] = time.sleep
) -> StreamingQuery:
    """Start a job and start it again when it fails, from its checkpoint.

    The checkpoint is the only thing carried over: Spark replays the batch that
    was under way with the same rows, and sinks replace what a batch has
    written. Pauses double from try to try. A try that completes a batch sets
    the count back, so that a long job survives many outages, while one that
    never gets on ends with GaveUp and the last error.
    """
    failed, reached = 0, -1
    while True:
        query = starter()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException as error:
            progress = query.lastProgress
            done = progress["batchId"] if progress else -1
            failed = 1 if done > reached else failed + 1
            reached = max(reached, done)
            if failed >= tries:
                raise GaveUp(f"{query.name or query.id} failed {failed} times in a row") from error
            wait = min(pause * 2 ** (failed - 1), LONGEST)
            logger.warning("%s failed, try %d of %d in %.1f s: %s", query.name or query.id, failed + 1, tries, wait, error)
            sleep(wait)

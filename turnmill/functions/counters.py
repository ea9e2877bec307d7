"""Length measures that are not built in, such as a tokenizer's."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F

#: What the counters of this worker process have set up, by key.
_READY: dict[str, Callable] = {}


def arrow_counter(make: Callable[[], Callable[[pa.Array], pa.Array]], key: str | None = None) -> Callable[[Column], Column]:
    """A counter for ``filter_long`` from a function of a whole batch of texts.

    ``make`` sets up what is costly (reads a vocabulary, say) and returns a function from an Arrow array of
    strings to one of integers of the same length.  It runs once per task, or with a ``key`` once per worker process:
    later tasks go on with what is there.  Texts reach the function in Arrow batches, never one by one, and NULL as NULL.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count = _READY.get(key) if key else None
        if count is None:
            count = make()
            if key:
                _READY[key] = count
        for texts in batches:
            counts = count(texts)
            if len(counts) != len(texts):
                raise ValueError(f"the counter gave {len(counts)} counts for {len(texts)} texts")
            yield counts.cast(pa.int64())

    return lambda text: F.arrow_udf(run, "long")(text)

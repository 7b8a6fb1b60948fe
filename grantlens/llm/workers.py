"""What functions that run in Python workers share."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys

import pyarrow as pa
from pyspark import TaskContext


class Lazy:
    """A value that a worker process builds when it first needs it and then keeps.

    It never travels: only the way to build it does.  What a worker kept for tasks of other stages goes
    when it builds something for a new one, so that a session of many stages does not gather them all.
    """

    def __init__(self, build, *args):
        self.build, self.args = build, args

    def __call__(self):
        # Functions that travel by value are new in every task; the main module stays.
        kept = vars(sys.modules["__main__"]).setdefault("_grantlens_kept", {})
        task = TaskContext.get()
        stage = task.stageId() if task else None
        key = (self.build.__module__, self.build.__qualname__, *self.args)
        if key not in kept:
            for old in [other for other, (_, of) in kept.items() if of != stage]:
                del kept[old]
            kept[key] = self.build(*self.args), stage
        value, of = kept[key]
        if of != stage:
            kept[key] = value, stage
        return value


def tidied(function):
    """A function of batches that gives freed memory back to the system when its task ends.

    Workers live on between tasks, and the allocators would hold on to the most that any task needed.
    """

    @functools.wraps(function)
    def run(*args):
        try:
            yield from function(*args)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run

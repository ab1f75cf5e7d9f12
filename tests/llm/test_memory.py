"""Python workers serve task after task; what one took has gone back to the system when the next begins."""

import numpy as np
import pyarrow as pa

from regraft.llm.common import in_arrow


def test_a_worker_keeps_no_memory_of_its_last_task(spark):
    def taken(batches):
        """Takes and frees 100 MB between small arrays that stay, and says how much the process held before."""
        for _ in batches:
            with open("/proc/self/status") as f:
                held = int(f.read().split("RssAnon:")[1].split()[0]) >> 10
            some = []
            for _ in range(1000):
                some.append(np.ones(100_000, np.uint8))
                np.__dict__.setdefault("kept_by_test", []).append(np.ones(2000, np.uint8))
            del some
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64())], ["held"])

    one = spark.range(1).coalesce(1)
    held = [in_arrow(one, taken, "held long").collect()[0].held for _ in range(4)]
    assert max(held) - min(held) < 60


def test_an_error_in_a_task_is_the_tasks_own(spark):
    def fails(batches):
        for batch in batches:
            yield batch
            raise ValueError("not this one")

    try:
        in_arrow(spark.range(1), fails, "id long").collect()
    except Exception as error:
        assert "not this one" in str(error)
    else:
        raise AssertionError("no error")

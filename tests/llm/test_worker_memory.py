"""What Python workers hold between tasks, of which an executor has several beside its heap."""

import re
from pathlib import Path

import numpy as np
import pytest

from millrace.llm import suffix_dedup, tables, toxicity


def _private() -> float:
    return int(re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[0]) / 1024


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory can't be read here")
def test_let_go_gives_memory_back_to_the_system():
    blocks = [np.ones(8000) for _ in range(3000)]  # 64 KB each, so of the heap, whose end the last one holds
    last = blocks.pop()
    tables.held("blocks", lambda: list(blocks))
    blocks.clear()
    full = _private()
    tables.let_go()
    assert _private() < full - 120 and len(last)


@pytest.mark.parametrize("task", [toxicity._packed, suffix_dedup._sorted_partition])
def test_tasks_of_other_stages_keep_no_encoder(task):
    tables.held("encoder", list)
    assert list(task(iter([]))) == [] and not tables._HELD

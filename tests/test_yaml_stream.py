"""Deadline lists are read an entry at a time."""

import tracemalloc

import pytest
import yaml

from kalendria.sources import files


def test_a_long_list_takes_little_more_than_its_text():
    text = "".join(f"- title: C{i}\n  year: 2025\n  place: P\n  deadline: '2025-01-02 23:59:59'\n" for i in range(1500))
    tracemalloc.start()
    got = sum(1 for _ in files.yaml_entries(text))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == 1500 and most < 20 * len(text)


def test_odd_documents_read_as_before():
    one = lambda t: [e["acronym"] for e in files.yaml_entries(t)]
    assert one("") == one("# none\n") == one("---\n") == one("x: 1\n") == []
    assert one("- &a {title: A}\n- *a\n- 3\n- <<: *a\n  year: 2025\n") == ["A", "A", "A"]
    assert one("[{title: A}, {name: B}]") == ["A", "B"]
    for wrong in ("- {title: A}\n---\n- {title: B}\n", "- [", "- *none\n"):
        with pytest.raises(yaml.YAMLError):
            one(wrong)

import re

import __spark_entry__ as entry
from matchpeaks.llm import queries


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries())
    assert numbers == list(range(1, 11))
    assert {*queries.queries(), "pipeline"} <= {*entry.queries()}

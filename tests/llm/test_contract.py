import re

import __spark_entry__ as contract
import corpus_pipeline


def test_every_operator_is_registered_once():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert set(contract.oracle_sql()) <= set(contract.queries())

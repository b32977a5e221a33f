import gzip
import json

from loreweave.__main__ import main
from loreweave.operators.checks import verdict_totals
from loreweave.operators.embedding import hashing_backend
from loreweave.plans.report import Expectations, run_checks
from loreweave.sources.warehouse import Warehouse


def test_report(spark, tmp_path):
    texts = {"Bolt": "Bolt deals {3} damage", "Cancel": "Counter target spell", "Lotus": "{T}: Add {B}{B}{B}"}
    data = {n: [{"identifiers": {"scryfallOracleId": n.lower()}, "manaValue": 1, "type": "T", "text": t, "name": n}]
            for n, t in texts.items()}
    dump = tmp_path / "d.gz"
    dump.write_bytes(gzip.compress(json.dumps({"meta": {"version": "v"}, "data": data}).encode()))
    root = str(tmp_path / "w")
    done = main([root, "--dump", str(dump)])
    assert done["sync"]["inserted"] == 3 and done["embed"] == {"card_name": 3, "card_text": 3}
    want = Expectations(
        min_rows=2, names=("Bolt", "Lotus"), phrases={"DAMAGE": 1, "counter target": 1},
        coverage={"card_name": 3, "card_text": 3}, name_queries=("Bolt", "Cancel"), text_queries=("counter a spell",),
    )
    report = run_checks(Warehouse(spark, root), hashing_backend(), want)
    got = {r.name: r.verdict for r in report.collect()}
    assert got.pop("vec_rules") == "skip" and set(got.values()) == {"pass"} and len(got) == 7
    assert verdict_totals(report).first().asDict() == {"passed": 7, "failed": 0, "skipped": 1, "total": 8, "ok": True}
    strict = Expectations(names=("Missing",), phrases={"damage": 2}, coverage={"rules": 1}, name_queries=("Nobody",))
    failed = {r.name for r in run_checks(Warehouse(spark, root), hashing_backend(), strict).collect() if r.verdict == "fail"}
    assert failed == {"foundation", "exact_name", "text_phrase", "embedding_coverage", "vec_card_name"}

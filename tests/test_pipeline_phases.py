import json

from ledgerloom import pipeline as P


class Step:
    def __init__(self, name, severity="ok", fail=False):
        self.name, self.severity, self.fail = name, severity, fail

    def run(self, context):
        if self.fail:
            raise ValueError("no table")
        context.tables[self.name] = context.spark.range(3)
        return P.PhaseResult(self.name, self.severity)


def test_phases_run_up_to_a_fatal_one_and_observers_hear_of_each(spark, tmp_path):
    heard = []
    c = P.run(P.Context(spark), [Step("read"), Step("extract", "warning"), Step("merge", fail=True), Step("never")], [lambda r: heard.append(r.name)])
    assert heard == ["read", "extract", "merge"] and set(c.tables) == {"read", "extract"}
    m = P.metrics(c)
    assert m["final_severity"] == "fatal" and [p["severity"] for p in m["phases"]] == ["ok", "warning", "fatal"] and "no table" in m["phases"][2]["message"]
    P.write_metrics(c, f"file://{tmp_path}/metrics")
    assert json.loads(spark.read.text(f"file://{tmp_path}/metrics").first()[0]) == m


def test_worst():
    assert P.worst([]) == "ok" and P.worst(["ok", "odd", "warning"]) == "warning" and P.metrics(P.Context(None))["phases"] == []

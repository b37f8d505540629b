import contextlib
import datetime
import io

from tallyloom.plans.voting_intention import RAW_COLUMNS, stage_cells
from tallyloom.session import tune

AT = datetime.datetime(2001, 8, 6, 10, tzinfo=datetime.timezone.utc)
CELLS = [
    ("1", "Inst[1]", "1 Jan - 2 fev", "1.000[3]", "± 2,5 p.p.", "Alfa  PA", "40,5%", AT),
    ("1", "Inst", "1 Jan - 2 fev", "", "± 2,5 p.p.", "Vantagem", "40,5%", AT),
    ("1", "Inst", "1 Jan - 2 fev", "1.000", "x", "Beta PB", "120", AT),
    ("1", "Inst", "1 Jan - 2 fev", "1.000", "x", "Beta PB", "", AT),
    ("1", "Inst", "event", "1.000", "x", "Beta PB", "10", AT),
    ("2", "Inst", "30 out", None, None, "Indecisos", "<1", AT),
]
KINDS = ", ".join(f"{c} string" for c in RAW_COLUMNS[:-1]) + ", _ingerido_em timestamp"


def test_cells_are_typed_and_dropped_as_before(spark):
    rows = [tuple(str(v) for v in r[:-1]) for r in stage_cells(tune(spark).createDataFrame(CELLS, KINDS)).collect()]
    assert sorted(rows) == [
        ("1", "Inst", "1 Jan - 2 fev", "2001-01-01", "2001-02-02", "1000", "2.50", "Alfa PA", "Candidato", "40.50"),
        ("2", "Inst", "30 out", "2000-10-30", "2000-10-30", "None", "None", "Indecisos", "Não-resposta", "1.00"),
    ]


def test_dropped_cells_are_typed_no_further(spark):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        stage_cells(tune(spark).createDataFrame(CELLS, KINDS)).explain()
    plan = printed.getvalue()
    # Read from the top: the samples, the answers and the values, each above the filter of the one before it.
    assert plan.index("amostra_texto") < plan.index("NOT (tp_resposta") < plan.index("indecis") < plan.index("pc_valor", plan.index("indecis"))
    assert plan[: plan.index("Generate")].count("amostra_texto") > 0

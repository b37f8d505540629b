import contextlib
import io
import os

from pyspark.sql import functions as F

from tallyloom.plans.voting_intention import standardise
from tallyloom.queries import load_all
from tallyloom.queries.sources_of_facts import lookups
from tallyloom.session import durable, durable_alone, shared_folder

SMALL = "/root/testdata/sf0.001"
CELLS = "tabela_idx int, nm_instituto_origem string, periodo_texto string, dt_inicio_campo date, dt_fim_campo date, qt_amostra int, " \
    "pc_margem_erro decimal(5,2), coluna_candidato string, tp_resposta string, pc_valor decimal(9,2), _ingerido_em timestamp"


def kept(spark):
    folder = shared_folder(spark).removeprefix("file://")
    return {name.rsplit("-", 1)[0] for name in os.listdir(folder)}, {os.path.join(folder, name) for name in os.listdir(folder)}


def test_results_on_the_way_go_when_the_last_one_is_stored(spark):
    before = kept(spark)[1]
    outside = durable(spark.range(5), "outside")

    def build():
        first = durable(spark.range(10), "way-first")
        inner = durable_alone(lambda: durable(first.where("id < 7"), "way-inner").where("id < 5"), "way-second")
        assert not {"way-inner"} & kept(spark)[0] and {"way-first", "way-second"} <= kept(spark)[0]
        return inner.join(outside, "id").groupBy((F.col("id") % 2).alias("odd")).count()

    found = durable_alone(build, "way-last")
    assert not {"way-first", "way-second"} & kept(spark)[0]
    assert {"outside", "way-last"} <= kept(spark)[0] and len(kept(spark)[1] - before) == 2
    assert sorted(map(tuple, found.collect())) == [(0, 3), (1, 2)] and outside.count() == 5


def test_a_failure_leaves_the_next_scope_alone(spark):
    with contextlib.suppress(ZeroDivisionError):
        durable_alone(lambda: durable(spark.range(3), "failed-first") and 1 / 0)
    assert durable(spark.range(3), "after-failure").count() == 3
    assert "after-failure" in kept(spark)[0]


def test_exchanges_of_a_stored_result_go(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def written():
        return {f for folder in folders for _, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")}

    before = written()
    spark.range(100).repartition(3, "id").count()
    assert written() - before
    before = written()
    counted = durable(spark.range(100_000).repartition(3, "id").groupBy((F.col("id") % 1000).alias("k")).count())
    assert not written() - before
    assert counted.count() == 1000


def test_hashes_stay_out_of_exchanges(spark):
    rows = spark.createDataFrame([], CELLS)
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        standardise(rows, *lookups(spark)[:2]).explain()
    plan = printed.getvalue()
    # Read from the top: the keys are hashed above every exchange.
    assert "sha2(" in plan and plan.rindex("sha2(") < plan.index("Exchange")


def test_panels_keep_only_what_their_result_reads(spark):
    before = kept(spark)[1]
    load_all()["linked_votes"].run(spark, SMALL)
    made = {os.path.basename(p).rsplit("-", 1)[0] for p in kept(spark)[1] - before}
    assert made == {"polls", "votes", "links"}
    before = kept(spark)[1]
    load_all()["lines_without_institute"].run(spark, SMALL)
    made = {os.path.basename(p).rsplit("-", 1)[0] for p in kept(spark)[1] - before}
    assert made == {"linked", "stored"}

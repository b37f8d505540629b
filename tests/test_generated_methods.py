from tallyloom.session import tune


def test_generated_methods_stay_small_enough_to_be_compiled(spark):
    assert int(tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000

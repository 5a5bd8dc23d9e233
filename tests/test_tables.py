import uuid

from tollgate.functions import rules as R
from tollgate.session import checkpoint_dir
from tollgate.sources.tables import register_path, reload_table


def test_reload_and_register_rules(spark):
    path = f"{checkpoint_dir(spark)}/rules-{uuid.uuid4().hex}"
    reload_table(R.ledger_rules(spark), path)
    reload_table(R.ledger_rules(spark).limit(3), path)      # truncate + reload
    register_path(spark, "tg_rules", path)
    assert spark.sql("SELECT count(*) FROM tg_rules").first()[0] == 3

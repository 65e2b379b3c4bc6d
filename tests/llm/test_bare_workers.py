"""Workers that cannot import the library run the operators all the same."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
# Workers are processes of their own, started without this script's search path.
found = spark.range(1).mapInPandas(lambda batches: (b.assign(id=int(__import__("importlib").util.find_spec("stormgrid") is not None)) for b in batches), "id long").first()[0]
assert found == 0, "the workers see the package"
from stormgrid.llm.queries import QUERIES
for name in ("op1_decontaminate", "op3_quality_classifier", "op4_masked_lm", "op6_simhash", "op8_html_text", "op11_warc", "op13_conversation_repair"):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    print("ran", name)
"""


def test_session_outside_the_repository(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=str(Path(__file__).resolve().parents[2])))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=900)
    assert done.stdout.count("ran op") == 7, done.stdout + done.stderr[-3000:]

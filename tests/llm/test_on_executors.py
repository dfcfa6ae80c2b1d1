"""The operators in a session as a cluster has it: executors without the package and few open files."""

import os
import subprocess
import sys

import pytest

SCRIPT = """
import resource, sys
resource.setrlimit(resource.RLIMIT_NOFILE, (4096, 4096))
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2])
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    .config("spark.sql.shuffle.partitions", sys.argv[3])
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")

def limited(batches):
    import resource
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, 256))
    try:
        import plumbline
        raise AssertionError("executors have the package")
    except ModuleNotFoundError:
        yield from batches

# All later tasks run in workers that this one has limited.
from plumbline.llm import queries
probe = spark.range(2).mapInArrow(limited, "id bigint")
assert probe.count() == 2
for name in sys.argv[4].split(","):
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


@pytest.mark.parametrize(
    "partitions, names",
    [
        (200, ["op1_language_model_kneser_ney"]),
        (
            8,
            [
                "op4_decontaminate_suffix_arrays",
                "op10_pack_sum_of_squares",
                "op11_tokenizer_alignment_spans",
                "op12_chat_prefix_tree",
                "op13_periodic_runs_difference_cover",
            ],
        ),
    ],
)
def test_executors_need_no_package_and_few_files(tmp_path, partitions, names):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, str(tmp_path / "shared"), str(partitions), ",".join(names)],
        cwd="/",
        env=environment,
        capture_output=True,
        text=True,
        timeout=500,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    rows = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert set(rows) == set(names) and all(int(n) > 20 for n in rows.values())

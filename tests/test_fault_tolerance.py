"""Lost tasks: every Python task of the archive reader fails on its first attempt and is retried.

Runs in a child process with ``local[4,3]`` (up to three attempts per task);
the result must equal a clean read, on the one-task and the unit-parallel path.
"""

import os
import subprocess
import sys
import textwrap

SCRIPT = textwrap.dedent(
    """
    import os, sys, zipfile
    sys.path.insert(0, {repo!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from rowsmith.sources import archive_units, archives
    from rowsmith.sources.archives import read_archive_lines

    d = {data!r}
    os.makedirs(d, exist_ok=True)
    for a in range(3):
        with zipfile.ZipFile(f"{{d}}/a{{a}}.zip", "w") as z:
            for e in range(4):
                z.writestr(f"e{{e}}", "".join(f"{{a}}-{{e}}-{{i}}\\n" for i in range(50)) + ("EOF\\n" if (a, e) == (1, 2) else ""))

    def rows(**kw):
        return sorted((r.file_name, r.line_no, r.value) for r in read_archive_lines(spark, d, first_data_line=3, **kw).collect())

    clean = rows(), rows(split_bytes=0, unit_bytes=100)
    real_open = archives.open_archive

    def flaky_open(uri):
        from pyspark import TaskContext
        if TaskContext.get().attemptNumber() == 0:
            raise IOError("executor lost")
        return real_open(uri)

    archives.open_archive = flaky_open
    archive_units.open_archive = flaky_open
    retried = rows(), rows(split_bytes=0, unit_bytes=100)
    assert retried == clean, "results differ after retries"
    assert len(clean[0]) == 3 * 4 * 50 - 3 * 2 - 50 and clean[0] == clean[1]
    print("RETRY-OK", len(clean[0]))

    def always_fails(uri):
        raise IOError("executor lost for good")

    archives.open_archive = always_fails  # control: the swapped opener really runs in the tasks
    try:
        rows()
        print("CONTROL-DID-NOT-FAIL")
    except Exception:
        print("CONTROL-FAILED")
    """
)


def test_archive_reads_survive_task_retries(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = SCRIPT.format(repo=repo, data=str(tmp_path / "z"))
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, cwd=str(tmp_path))
    assert "RETRY-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-4000:]
    assert "CONTROL-FAILED" in out.stdout

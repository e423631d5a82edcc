import re
from pathlib import Path

from riskframe.llm.common import free_finished


def test_free_native_memory_of_the_driver_goes_back(spark):
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    def held() -> float:
        """MB of the driver's JVM, without mapped files."""
        rollup = Path(f"/proc/{pid}/smaps_rollup").read_text()
        return int(re.search(r"\nPss_Anon:\s+(\d+)", rollup)[1]) / 1024

    # Each takes some blocks of native memory; those that stay keep the C library from returning the rest.
    made = [jvm.java.util.zip.Deflater() for _ in range(1000)]
    for i, deflater in enumerate(made):
        if i % 20:
            deflater.end()
    jvm.System.gc()
    before = held()
    free_finished(spark)
    assert before - held() > 50
    for deflater in made[::20]:
        deflater.end()

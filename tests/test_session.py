"""What is sent to the workers can be imported there."""

import os
import subprocess
import sys
import zipfile

from boxwise import session


def test_every_module_imports_from_the_shipped_archive(tmp_path):
    path = str(tmp_path / "boxwise.zip")
    session.zip_package(path)
    names = [n[:-3].replace("/", ".") for n in zipfile.ZipFile(path).namelist() if n.endswith(".py")]
    # registries are the driver's
    names = [n[:-len(".__init__")] if n.endswith(".__init__") else n for n in names if n != "boxwise.registry"]
    assert "boxwise.operators.evaluate" in names and "boxwise.operators.score" in names
    package = os.path.dirname(os.path.abspath(session.__file__))
    assert all(os.path.exists(os.path.join(f, "__init__.py")) for f, _, found in os.walk(package)
               if any(n.endswith(".py") for n in found))
    code = ("import importlib, sys; sys.path.insert(0, sys.argv[1])\n"
            "for n in sys.argv[2:]:\n    m = importlib.import_module(n)\n    assert sys.argv[1] in (m.__file__ or ''), (n, m.__file__)")
    done = subprocess.run([sys.executable, "-c", code, path, *names], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_shuffle_files_go_with_the_write(spark):
    """What a stored frame was shuffled through is deleted behind its write; the frame itself can still run."""
    import time

    from boxwise.session import DROP_SHUFFLES, materialize

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    d = spark.range(5000).selectExpr("id % 700 AS k").repartition(4).groupBy("k").count()
    before, was = files(), spark.conf.get(DROP_SHUFFLES)
    kept = materialize(d, "t-dropped")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and spark.conf.get(DROP_SHUFFLES) == was
    assert kept.count() == d.count() == d.count() == 700

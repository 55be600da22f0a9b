from __future__ import annotations

import subprocess
import sys

from pyspark import cloudpickle

from tidecast.operators import isolation, trees


def test_functions_load_without_the_package(tmp_path):
    """Executors get the code with the job: nothing of the package has to be importable there."""
    data = cloudpickle.dumps((isolation._grow, trees.attribute, trees.Nodes))
    code = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read())[0].__name__)"
    out = subprocess.run(
        [sys.executable, "-c", code], input=data, capture_output=True, cwd=tmp_path, check=True
    )
    assert out.stdout.decode().strip() == "_grow"

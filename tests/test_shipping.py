from __future__ import annotations

import os
import subprocess
import sys

from pyspark.serializers import CloudPickleSerializer

from winnow.operators import nearest


def test_task_functions_do_not_need_the_package(tmp_path):
    payload = tmp_path / "f.pkl"
    payload.write_bytes(CloudPickleSerializer().dumps(nearest._block_top_k))
    code = (
        "import sys, numpy as np, pandas as pd\n"
        "from pyspark.serializers import CloudPickleSerializer as S\n"
        f"f = S().loads(open({str(payload)!r}, 'rb').read())\n"
        "v = pd.Series([np.array([1.0, 0.0]), np.array([0.0, 1.0])])\n"
        "out = f(pd.DataFrame({'query_id': [1, 2], 'vec': v}), pd.DataFrame({'item_id': [7, 8], 'vec': v}), 1, 'ip')\n"
        "assert list(out.item_id) == [7, 8] and 'winnow' not in sys.modules\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True, timeout=120)

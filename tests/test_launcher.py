import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_launcher_starts_from_any_folder(tmp_path):
    done = subprocess.run([sys.executable, str(ROOT / "run_signals.py")], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 2 and "RAW_PATH OUT_PATH" in done.stdout

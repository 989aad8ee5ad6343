"""What keeps the whole tree of tests collectable."""

from collections import Counter
from pathlib import Path


def test_no_two_test_files_share_a_name():
    """Test folders are no packages, so files of one name would shut each other out."""
    names = Counter(path.name for path in Path(__file__).parent.rglob("test_*.py"))
    assert [name for name, times in names.items() if times > 1] == []

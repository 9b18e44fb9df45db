"""``python -m refinery <command> ...`` / ``spark-submit refinery/__main__.py <command> ...``"""

import sys

from refinery.cli import main

if __name__ == "__main__":
    sys.exit(main())

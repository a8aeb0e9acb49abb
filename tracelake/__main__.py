"""``python -m tracelake <job> ...``: the command-line jobs."""

import sys

from tracelake.cli import main

sys.exit(main())

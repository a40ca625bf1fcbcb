"""``python -m filelens ...`` runs the command line (see :mod:`filelens.cli`)."""

import sys

from filelens.cli import main

sys.exit(main())

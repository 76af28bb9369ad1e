import sys

from orchardflow.cli import main

sys.exit(main())

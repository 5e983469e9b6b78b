import sys

from riverwatch.cli import main

sys.exit(main())

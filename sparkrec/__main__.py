import sys

from sparkrec.cli import main

sys.exit(main())

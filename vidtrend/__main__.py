import sys

from vidtrend.cli import main

sys.exit(main())

import sys

from alertfold.plans.cli import main

sys.exit(main())

import sys

from tidemark.onboarding.cli import main

sys.exit(main())

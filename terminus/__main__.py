import sys

from terminus.plans.commands import main

sys.exit(main())

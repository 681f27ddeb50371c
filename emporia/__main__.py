import sys

from emporia.cli import main

sys.exit(main())

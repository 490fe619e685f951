import sys

from salesmart.cli import main

main(sys.argv[1:])

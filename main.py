"""``spark-submit main.py <session|page|area|ads> ...``; on a cluster add the package with
``--py-files``."""

from clickloom.app import main

if __name__ == "__main__":
    main()

"""spark-submit entry point: ``spark-submit --py-files palmyra.zip scripts/run_job.py p2 ...``
(same arguments as ``python -m palmyra``)."""

from palmyra.__main__ import main

if __name__ == "__main__":
    main()

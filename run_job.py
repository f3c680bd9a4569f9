"""spark-submit launcher for the batch jobs: ``spark-submit run_job.py <job> [options]``
(ship the package with ``--py-files``); see ``tagfold/jobs.py`` for the jobs."""

import sys

from tagfold.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])

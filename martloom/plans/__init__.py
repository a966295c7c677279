"""Jobs composed from the operators: refinement, marts, serving reports, audit, pipelines."""

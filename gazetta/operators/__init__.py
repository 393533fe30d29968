"""DataFrame operators: candidates, hierarchy, matching, segmentation, metrics, sampling."""

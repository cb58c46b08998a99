"""What executed plans tell about their scans."""


def scan_metrics(df, scan, metric):
    """A metric of each scan of an executed frame whose node name starts with ``scan``."""
    found, waiting = [], [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name.startswith(scan):
            found.append(node.metrics().apply(metric).value())
        if name == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        elif "QueryStage" in name:
            waiting.append(node.plan())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found
